"""Static and flat series, and magnitude-response points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.functions.numbers import is_valid
from hazardlens.operators.axes import KEYS
from hazardlens.operators.joins import lookup_join

# fixed values: response metrics in the order they are tried
RESPONSE_METRICS = {
    "damage": "adjusted_hazard_damage",
    "disruption": "adjusted_hazard_disruption",
    "value_impact": "adjusted_hazard_value_impact",
}
SERIES = ["asset_name", "scenario", "hazard", "indicator", "unit"]


def twelve_digits(c) -> Column:
    """A number as text of 12 significant digits; null stays null."""
    value = F.col(c) if isinstance(c, str) else c
    unsigned_zero = F.when(value == 0, F.lit(0.0)).otherwise(value)
    return F.when(is_valid(value), F.format_string("%.11e", unsigned_zero))


def static_hazard(hazards: DataFrame, col: str = "adjusted_hazard_value_impact") -> DataFrame:
    """Hazards whose impact has more than one value and all of them equal.

    All scenarios and horizons of the asset's hazard count. One distinct value is
    the same as an equal smallest and largest text, so no distinct count is needed.
    """
    text = twelve_digits(col)
    return (
        hazards.groupBy("asset_name", "hazard")
        .agg(F.count(text).alias("n_values"), F.min(text).alias("_lo"), F.max(text).alias("_hi"))
        .select(
            "asset_name",
            "hazard",
            "n_values",
            ((F.col("n_values") > 1) & (F.coalesce(F.col("_lo") == F.col("_hi"), F.lit(False)))).alias(
                "is_static"
            ),
        )
    )


def with_static_flag(hazards: DataFrame, col: str = "adjusted_hazard_value_impact") -> DataFrame:
    """The rows with ``is_static`` of their asset's hazard (``static_hazard``), read once."""
    every = Window.partitionBy("asset_name", "hazard")
    text = twelve_digits(col)
    several, low, high = F.count(text).over(every) > 1, F.min(text).over(every), F.max(text).over(every)
    return hazards.withColumn("is_static", several & F.coalesce(low == high, F.lit(False)))


def is_flat(table: DataFrame, keys: Sequence[str], col: str, tolerance: float = 1e-9) -> DataFrame:
    """Series with fewer than two values, or hardly any spread between them."""
    value = F.when(is_valid(col), F.col(col))
    spread = F.abs(F.max(value) - F.min(value)) <= tolerance
    return table.groupBy(*keys).agg(
        F.count(value).alias("n_values"),
        F.coalesce((F.count(value) < 2) | spread, F.lit(True)).alias("is_flat"),
    )


def response_metric(hazards: DataFrame) -> DataFrame:
    """Hazard rows with the first metric that is quantified anywhere in their series."""
    # a series holds one row per horizon
    series = Window.partitionBy("asset_name", "scenario", "hazard")
    name = F.lit(None).cast("string")
    value = F.lit(None).cast("double")
    for label, col in reversed(list(RESPONSE_METRICS.items())):
        found = F.max(is_valid(col)).over(series)
        name = F.when(found, F.lit(label)).otherwise(name)
        value = F.when(found, F.col(col)).otherwise(value)
    return hazards.select(*KEYS, "hazard", name.alias("metric"), value.alias("y"))


def response_points(indicators: DataFrame, hazards: DataFrame) -> DataFrame:
    """Indicator magnitude joined to the hazard's response at the same horizon."""
    x = indicators.where(is_valid("value") & F.col("hazard").isNotNull()).select(
        *KEYS,
        "hazard",
        F.coalesce(F.nullif("indicator", F.lit("")), F.lit("-")).alias("indicator"),
        F.coalesce("unit", F.lit("")).alias("unit"),
        F.col("value").alias("x"),
        "rating",
        "seq",
    )
    y = response_metric(hazards).where(is_valid("y"))
    return lookup_join(x, y, [*KEYS, "hazard"], "inner")


def magnitude_response(indicators: DataFrame, hazards: DataFrame, k: int = 4, min_points: int = 3) -> DataFrame:
    """The points of the ``k`` most varied series per asset, scenario and hazard, one row each.

    Read them by x, then horizon. A series needs ``min_points`` points and two magnitudes.
    Its numbers of different values are the last of their dense ranks, so points and
    series come from one pass. This is a derived view over returned rows, not a damage
    curve of the vendor.
    """
    group = ["asset_name", "scenario", "hazard"]
    # dealt by the group once; the windows over its series need no other order of rows than they sort
    points = response_points(indicators, hazards).repartition(*group)
    series = Window.partitionBy(*SERIES)
    ranked = points.withColumns(
        {
            "_x": F.dense_rank().over(series.orderBy(twelve_digits("x"))),
            "_y": F.dense_rank().over(series.orderBy(twelve_digits("y"))),
        }
    )
    measured = ranked.withColumns(
        {
            "n_points": F.count("*").over(series),
            "distinct_x": F.max("_x").over(series).cast("bigint"),
            "distinct_y": F.max("_y").over(series).cast("bigint"),
        }
    ).where((F.col("n_points") >= min_points) & (F.col("distinct_x") > 1))
    order = Window.partitionBy(*group).orderBy(F.col("distinct_y").desc(), F.col("distinct_x").desc(), "indicator", "unit")
    # the rows of a series share its rank
    kept = measured.withColumn("series_rank", F.dense_rank().over(order)).where(F.col("series_rank") <= k)
    rest = [c for c in points.columns if c not in SERIES]
    return kept.select(*SERIES, *rest, "n_points", "distinct_x", "distinct_y", "series_rank")
