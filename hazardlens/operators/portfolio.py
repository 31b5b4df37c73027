"""Portfolio questions: ratings, roll-ups, top assets and drivers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.ratings import LETTERS, rating_letter, rating_score
from hazardlens.functions.text import is_blank
from hazardlens.operators.joins import lookup_join
from hazardlens.operators.series import top_rows


def portfolio_rating(table: DataFrame, keys: Sequence[str], col: str, half_up: bool = True) -> DataFrame:
    """Letter of the rounded mean score over valid ratings, with the distribution behind it.

    The mean is taken from exact sums, so partitioning cannot change it.
    """
    score = rating_score(col)
    valid = F.when(score > 0, score)
    mean = F.sum(valid) / F.count(valid)
    rounded = F.round(mean, 0) if half_up else F.bround(mean, 0)
    return table.groupBy(*keys).agg(
        rating_letter(rounded).alias("portfolio_rating"),
        F.count(valid).alias("rated"),
        F.count_if(score == 0).alias("unrated"),
        *[F.count_if(score == i).alias(f"rating_{x}") for i, x in enumerate(LETTERS, 1)],
    )


def with_portfolio(results: DataFrame, manifest: DataFrame, name: str = "asset_name") -> DataFrame:
    """Result rows of assets in the manifest, with portfolio and plant ids."""
    right = manifest.select(
        F.col("scr_asset_name").alias(name),
        *[F.col(f"manifest.{c}").alias(c) for c in ("portfolio_id", "portfolio_asset_id", "plant_uuid")],
    )
    return lookup_join(results, right, [name], "inner")


def portfolio_rollup(
    table: DataFrame, rating: str, value: str, keys: Sequence[str] = ("portfolio_id", "ticcs_sub_class")
) -> DataFrame:
    """Assets, worst rating and largest value per portfolio and sector, with subtotals.

    ``table`` has one row per asset. ``level`` counts the keys that were rolled up.
    """
    return table.rollup(*keys).agg(
        F.grouping_id().alias("level"),
        F.count("*").alias("n_assets"),
        rating_letter(F.max(rating_score(rating))).alias("worst_rating"),
        F.max(value).alias("max_value"),
    )


def top_exposed_assets(table: DataFrame, rating: str, value: str, k: int = 10) -> DataFrame:
    """The ``k`` most exposed assets of every portfolio, by rating, then value, then name."""
    order = [
        rating_score(rating).desc(),
        F.coalesce(F.col(value), F.lit(float("-inf"))).desc(),
        F.col("asset_name"),
    ]
    return top_rows(table, ["portfolio_id"], order, k)


def top_drivers(table: DataFrame, driver: str, value: str, k: int = 5) -> DataFrame:
    """Hazards or subrisks of a portfolio by the largest value any of its assets has."""
    per_driver = (
        table.where(~is_blank(driver))
        .groupBy("portfolio_id", driver)
        .agg(F.max(value).alias("max_value"), F.count_distinct("asset_name").alias("n_assets"))
    )
    order = [F.coalesce(F.col("max_value"), F.lit(float("-inf"))).desc(), F.col(driver)]
    return top_rows(per_driver, ["portfolio_id"], order, k)


def scenario_comparison(table: DataFrame, scenarios: Sequence[str], col: str, keys: Sequence[str]) -> DataFrame:
    """The same metric side by side, one column per scenario."""
    return table.groupBy(*keys).agg(
        *[F.max(F.when(F.col("scenario") == s, F.col(col))).alias(s) for s in scenarios]
    )
