"""Report tables: each answers one question a reader of the results asks.

Every report covers all assets in one job. A caller who wants one asset filters
the result tables first, and the filter reaches the Parquet partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.ordering import file_order
from hazardlens.functions.display import (
    display_value,
    driver_label,
    impact_label,
    magnitude_label,
    number_text,
    peak_label,
)
from hazardlens.functions.numbers import is_valid
from hazardlens.functions.ratings import rating_band, rating_score, rating_tone
from hazardlens.functions.text import blank_to_null, first_non_blank
from hazardlens.operators import axes, portfolio, response, series, transition
from hazardlens.operators.axes import KEYS

# fixed values: physical metrics a reader can choose
PHYSICAL_METRICS = {
    "value_impact": ("adjusted_total_value_impact", "Physical value impact"),
    "disruption": ("adjusted_total_disruption", "Physical revenue/business disruption"),
}
CURVE_METRICS = [
    "adjusted_hazard_damage",
    "adjusted_hazard_disruption",
    "adjusted_hazard_disruption_damage_equivalent",
    "adjusted_hazard_value_impact",
]
TABLE_ROWS = 18


@dataclass(frozen=True)
class Results:
    """The analytic tables of one result build."""

    assets: DataFrame
    trends: DataFrame
    hazards: DataFrame
    indicators: DataFrame
    rankings: DataFrame
    transition_trends: DataFrame
    subrisks: DataFrame


def metric_column(metric: str) -> str:
    return PHYSICAL_METRICS.get(metric, PHYSICAL_METRICS["value_impact"])[0]


def hazard_order() -> list[Column]:
    """Largest value impact first, null as zero, then worst rating, then name."""
    return [
        F.coalesce("adjusted_hazard_value_impact", F.lit(0.0)).desc(),
        rating_score("hazard_rating").desc(),
        F.col("hazard"),
    ]


def peak_order() -> list[Column]:
    return [F.coalesce("peak_impact", F.lit(0.0)).desc(), F.col("scenario")]


def top_hazards(hazards: DataFrame, k: int = 1) -> DataFrame:
    return series.top_rows(hazards, KEYS, hazard_order(), k)


def selected_view(res: Results, scenario: str | None = None, horizon: int | None = None) -> DataFrame:
    """One physical slice per asset: the asked one where the asset has it, else its default."""
    return axes.default_physical_slice(
        res.trends, (scenario, axes.PREFERRED_PHYSICAL_SCENARIO), (horizon, axes.PREFERRED_HORIZON)
    )


def physical_trend_series(
    trends: DataFrame, metric: str = "value_impact", unit: str = "percent"
) -> DataFrame:
    """One physical metric by scenario and horizon, raw and in a display unit."""
    col = metric_column(metric)
    return trends.select(
        *KEYS,
        F.col(col).alias("raw_value"),
        display_value(col, unit).alias("display_value"),
        impact_label(col, unit).alias("label"),
        F.col("adjusted_physical_exposure_rating").alias("rating"),
    )


def hazard_ranking(hazards: DataFrame) -> DataFrame:
    """Hazards of every view in order, with bar share, band and the static flag."""
    flagged = response.with_static_flag(hazards)
    ranked = series.rank_position(flagged, KEYS, hazard_order())
    shared = series.bar_share(ranked, KEYS, "adjusted_hazard_value_impact")
    return shared.withColumns(
        {"band": rating_band("hazard_rating"), "label": impact_label("adjusted_hazard_value_impact")}
    )


def hazard_curves(hazards: DataFrame) -> DataFrame:
    """Four hazard metrics in long form with a flat flag per curve."""
    long = hazards.unpivot(
        [*KEYS, "hazard"], CURVE_METRICS, variableColumnName="metric", valueColumnName="value"
    )
    keys = ["asset_name", "scenario", "hazard", "metric"]
    flat = response.is_flat(long, keys, "value").drop("n_values")
    return long.where(is_valid("value")).join(flat, keys)


def indicator_table(indicators: DataFrame, k: int = TABLE_ROWS) -> DataFrame:
    """The ``k`` worst rated indicators of every view."""
    order = [
        rating_score("rating").desc(),
        F.coalesce("hazard", F.lit("")),
        F.coalesce("indicator", F.lit("")),
        *map(F.col, file_order(indicators)),
    ]
    top = series.top_rows(axes.rated(indicators), KEYS, order, k)
    return top.withColumns(
        {
            "band": rating_band("rating"),
            "tone": rating_tone("rating"),
            "magnitude": magnitude_label("value", "unit"),
        }
    ).drop("source_file", "seq")


def transition_ranking(subrisks: DataFrame, rankings: DataFrame, driver: str = "all") -> DataFrame:
    """Scenarios of each asset by peak impact, with both driver peaks beside it."""
    base = transition.rankings_for_driver(subrisks, rankings, driver)
    ranked = series.rank_position(base, ["asset_name"], peak_order())
    shared = series.bar_share(ranked, ["asset_name"], "peak_impact")
    return shared.select(
        "asset_name",
        "position",
        "scenario",
        "peak_impact",
        "peak_year",
        "peak_subrisk",
        driver_label("peak_subrisk").alias("driver_label"),
        "bar_share",
        peak_label("direct_carbon_peak.value", "direct_carbon_peak.year").alias("direct_label"),
        peak_label("market_demand_peak.value", "market_demand_peak.year").alias("market_label"),
    )


def subrisk_table(subrisks: DataFrame, driver: str = "all", k: int = TABLE_ROWS) -> DataFrame:
    """The ``k`` largest quantified impacts per asset and scenario."""
    order = [
        F.col("adjusted_revenue_impact").desc(),
        F.col("horizon"),
        F.coalesce("subrisk", F.lit("")),
        F.coalesce("indicator", F.lit("")),
        *map(F.col, file_order(subrisks)),
    ]
    rows = axes.quantified(axes.filter_driver(subrisks, driver), "adjusted_revenue_impact")
    return series.top_rows(rows, ["asset_name", "scenario"], order, k).drop("source_file", "seq")


def asset_kpis(
    res: Results,
    scenario: str | None = None,
    horizon: int | None = None,
    transition_scenario: str | None = None,
    driver: str = "all",
    metric: str = "value_impact",
) -> DataFrame:
    """One row per asset: rating, impact and its change, top hazard, top peak, selected scenario."""
    view = selected_view(res, scenario, horizon)
    col = metric_column(metric)
    trend = series.change_from_first(res.trends, col).select(
        *KEYS,
        F.col("adjusted_physical_exposure_rating").alias("physical_rating"),
        F.col(col).alias("impact"),
        "change_pct",
    )
    hazard = top_hazards(res.hazards).select(*KEYS, F.col("hazard").alias("top_hazard"))

    ranked = transition.rankings_for_driver(res.subrisks, res.rankings, driver)
    peak = F.struct("scenario", "peak_impact", "peak_year", "peak_subrisk")
    order = F.struct((-F.coalesce("peak_impact", F.lit(0.0))).alias("v"), F.col("scenario").alias("s"))
    wanted = transition_scenario or axes.PREFERRED_TRANSITION_SCENARIO
    chosen = F.min_by(peak, F.when(F.col("scenario") == wanted, order))
    peaks = ranked.groupBy("asset_name").agg(
        F.min_by(peak, order).alias("top"), F.coalesce(chosen, F.min_by(peak, order)).alias("selected")
    )
    return (
        res.assets.join(view, "asset_name", "left")
        .join(trend, KEYS, "left")
        .join(hazard, KEYS, "left")
        .join(peaks, "asset_name", "left")
        .select(
            "asset_name",
            first_non_blank("scr_asset_id", "asset_name").alias("asset_label"),
            F.coalesce(first_non_blank("ticcs_sub_class_name", "ticcs_sub_class"), F.lit("")).alias("sector"),
            "coordinates",
            "scenario",
            "horizon",
            "physical_rating",
            "impact",
            "change_pct",
            "top_hazard",
            F.col("top.scenario").alias("top_scenario"),
            F.col("top.peak_impact").alias("top_peak"),
            F.col("top.peak_year").alias("top_peak_year"),
            F.col("selected.scenario").alias("selected_scenario"),
            F.col("selected.peak_impact").alias("selected_peak"),
            F.col("selected.peak_year").alias("selected_peak_year"),
            F.col("selected.peak_subrisk").alias("selected_driver"),
        )
    )


def interpretation(res: Results, metric: str = "value_impact", driver: str = "all", **view) -> DataFrame:
    """The KPI row with a sentence about each of both risks."""
    rows = asset_kpis(res, metric=metric, driver=driver, **view)
    rating = F.coalesce(blank_to_null("physical_rating"), F.lit("-"))
    # format_string turns a null into text, so the null is caught before it
    moved = F.when(
        F.col("change_pct").isNotNull(),
        F.format_string(", a %.1f%% move from the first horizon", "change_pct"),
    ).otherwise("")
    hazard = F.coalesce(
        F.concat(F.lit(" The top quantified hazard is "), F.col("top_hazard"), F.lit(".")), F.lit("")
    )
    physical = F.concat(
        F.coalesce("scenario", F.lit("-")),
        F.lit(" at "),
        F.coalesce(F.col("horizon").cast("string"), F.lit("-")),
        F.lit(": rating "),
        rating,
        F.lit(", impact "),
        impact_label("impact", include_raw=True),
        moved,
        F.lit("."),
        hazard,
    )
    transition_text = F.concat(
        F.lit("Highest peak: "),
        F.coalesce("top_scenario", F.lit("-")),
        F.lit(" with "),
        number_text("top_peak"),
        F.lit(". Selected: "),
        F.coalesce("selected_scenario", F.lit("-")),
        F.lit(", led by "),
        driver_label("selected_driver"),
        F.lit(" at "),
        F.coalesce(F.col("selected_peak_year").cast("string"), F.lit("-")),
        F.lit("."),
    )
    return rows.withColumns({"physical_text": physical, "transition_text": transition_text})


def physical_summary(res: Results, n_hazards: int = 3, n_indicators: int = 3) -> DataFrame:
    """Per view: rating, value impact and the names of the top hazards and indicators."""
    # at most n names per view reach each list
    hazard_names = _top_names(series.top_rows(res.hazards, KEYS, hazard_order(), n_hazards), "hazard")
    order = [
        rating_score("rating").desc(),
        F.coalesce("hazard", F.lit("")),
        F.coalesce("indicator", F.lit("")),
        F.col("seq"),
    ]
    rated = axes.rated(res.indicators)
    indicator_names = _top_names(series.top_rows(rated, KEYS, order, n_indicators), "indicator")
    return (
        res.trends.select(
            *KEYS,
            F.col("adjusted_physical_exposure_rating").alias("rating"),
            F.col("adjusted_total_value_impact").alias("value_impact"),
        )
        .join(hazard_names.withColumnRenamed("names", "top_hazards"), KEYS, "left")
        .join(indicator_names.withColumnRenamed("names", "top_indicators"), KEYS, "left")
    )


def _top_names(top: DataFrame, col: str) -> DataFrame:
    named = F.struct("position", F.coalesce(col, F.lit("-")).alias("name"))
    return top.groupBy(*KEYS).agg(
        F.concat_ws("|", F.transform(F.array_sort(F.collect_list(named)), lambda x: x["name"])).alias("names")
    )


def transition_summary(res: Results) -> DataFrame:
    """Per view: rating, largest impact, its subrisk and the indicator behind it."""
    best = transition.best_impact(res.subrisks, KEYS).select(*KEYS, "indicator")
    return res.transition_trends.join(best, KEYS, "left")


def driver_split(rankings: DataFrame) -> DataFrame:
    """Whether carbon cost or market demand leads, per asset and scenario."""
    flat = transition.flat_rankings(rankings).select(
        "asset_name", "scenario", "direct_carbon_value", "market_demand_value"
    )
    direct = F.coalesce("direct_carbon_value", F.lit(float("-inf")))
    market = F.coalesce("market_demand_value", F.lit(float("-inf")))
    return flat.withColumn(
        "leading_driver",
        F.when(direct > market, transition.DIRECT_CARBON)
        .when(market > direct, transition.MARKET_DEMAND)
        .when(F.col("direct_carbon_value").isNotNull(), "equal"),
    )


def scenario_compare(
    trends: DataFrame, scenarios: Sequence[str], col: str = "adjusted_total_value_impact"
) -> DataFrame:
    """One metric per asset and horizon, scenarios side by side."""
    return portfolio.scenario_comparison(trends, scenarios, col, ["asset_name", "horizon"])


def portfolio_report(
    res: Results, manifest: DataFrame, scenario: str, horizon: int, scenarios: Sequence[str], k: int = 10
) -> dict[str, DataFrame]:
    """Rating mix, top assets, top drivers, sector roll-up and scenario comparison."""
    rating, value = "adjusted_physical_exposure_rating", "adjusted_total_value_impact"
    sector = res.assets.select("asset_name", "ticcs_sub_class")
    trends = portfolio.with_portfolio(res.trends, manifest)
    view = axes.slice_view(trends, scenario, horizon).join(sector, "asset_name", "left")
    hazards = portfolio.with_portfolio(axes.slice_view(res.hazards, scenario, horizon), manifest)
    peaks = portfolio.with_portfolio(res.rankings, manifest)
    return {
        "ratings": portfolio.portfolio_rating(view, ["portfolio_id"], rating),
        "top_assets": portfolio.top_exposed_assets(view, rating, value, k),
        "sectors": portfolio.portfolio_rollup(view, rating, value),
        "top_hazards": portfolio.top_drivers(hazards, "hazard", "adjusted_hazard_value_impact"),
        "top_subrisks": portfolio.top_drivers(peaks, "peak_subrisk", "peak_impact"),
        "scenarios": portfolio.scenario_comparison(trends, scenarios, value, ["portfolio_id", "horizon"]),
    }
