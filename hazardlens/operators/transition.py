"""Transition risk: trends, subrisk peaks, scenario rankings, driver views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.numbers import comparable, float_column, is_valid
from hazardlens.functions.ordering import ROW_ORDER, file_order, first_of_largest, order_key
from hazardlens.functions.ratings import rating_letter, rating_score
from hazardlens.functions.text import first_non_blank, is_blank
from hazardlens.operators.axes import KEYS, filter_driver, subrisk_rows, valid_axes

IMPACT = "adjustedSubriskRevenueImpact"

# fixed values: the two transition drivers
DIRECT_CARBON, MARKET_DEMAND = "Direct_carbon_cost", "Market_demand_shifts"


def transition_trends(rows: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """Largest revenue impact, the subrisk behind it and the worst rating.

    The subrisk is that of the first row in file order among equal impacts, and
    may be null.
    """
    base = valid_axes(rows)
    impact = comparable(float_column(base, IMPACT))
    rating = first_non_blank("adjustedTransitionExposureRating", "transitionExposureRating")
    top = first_of_largest(
        F.struct(impact.alias("impact"), F.col("subrisk")), impact, impact.isNotNull(), [order_key(order)]
    )
    return (
        base.groupBy(*KEYS)
        .agg(top.alias("_top"), F.max(rating_score(rating)).alias("_score"))
        .select(
            *KEYS,
            F.col("_top.impact").alias("max_adjusted_subrisk_revenue_impact"),
            F.col("_top.subrisk").alias("top_subrisk"),
            rating_letter("_score").alias("transition_rating"),
        )
    )


def _leading(payload: Column, value: Column, where: Column, place: Column) -> tuple[Column, Column]:
    """Candidates for a running maximum that starts from the first row.

    A first row that is NaN is never beaten, since nothing compares above NaN; a
    later NaN never wins.
    """
    first = F.min_by(payload, F.when(where, place))
    best = first_of_largest(payload, value, where & ~F.isnan(value), [place])
    return first, best


def _pick(first: str, best: str, field: str) -> Column:
    return F.when(F.isnan(F.col(f"{first}.{field}")), F.col(first)).otherwise(F.col(best))


def subrisk_peaks(rows: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """The peak of every subrisk per asset and scenario, and where it was first seen."""
    base = valid_axes(rows).where(~is_blank("subrisk"))
    base = base.withColumn("value", float_column(base, IMPACT)).where(F.col("value").isNotNull())
    place = order_key(order)
    payload = F.struct(
        F.col("value"),
        F.col("horizon").alias("year"),
        first_non_blank("adjustedSubriskExposureRating", "subriskExposureRating").alias("rating"),
    )
    first, best = _leading(payload, F.col("value"), F.lit(True), place)
    return (
        base.groupBy("asset_name", "scenario", "subrisk")
        .agg(first.alias("_first"), best.alias("_best"), F.min(place).alias("first_seen"))
        .withColumn("_peak", _pick("_first", "_best", "value"))
        .select("asset_name", "scenario", "subrisk", "_peak.value", "_peak.year", "_peak.rating", "first_seen")
    )


def rank_scenarios(peaks: DataFrame) -> DataFrame:
    """Peaks per subrisk to one row per asset and scenario, with both drivers nested."""
    payload = F.struct("asset_name", "subrisk", "value", "year", "rating")
    first, best = _leading(payload, F.col("value"), F.lit(True), F.col("first_seen"))

    def of(subrisk):
        return F.max_by(payload, F.when(F.col("subrisk") == subrisk, F.lit(1)))

    return (
        peaks.groupBy("asset_name", "scenario")
        .agg(
            first.alias("_first"),
            best.alias("_best"),
            of(DIRECT_CARBON).alias("direct_carbon_peak"),
            of(MARKET_DEMAND).alias("market_demand_peak"),
        )
        .withColumn("_peak", _pick("_first", "_best", "value"))
        .select(
            "asset_name",
            "scenario",
            F.col("_peak.value").alias("peak_impact"),
            F.col("_peak.year").alias("peak_year"),
            F.col("_peak.subrisk").alias("peak_subrisk"),
            "direct_carbon_peak",
            "market_demand_peak",
        )
    )


def scenario_rankings(rows: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    return rank_scenarios(subrisk_peaks(rows, order))


def flat_rankings(rankings: DataFrame) -> DataFrame:
    """Scenario rankings with the nested peaks spread into columns."""
    return rankings.select(
        "asset_name",
        "scenario",
        "peak_impact",
        "peak_year",
        "peak_subrisk",
        F.col("direct_carbon_peak.value").alias("direct_carbon_value"),
        F.col("direct_carbon_peak.year").alias("direct_carbon_year"),
        F.col("direct_carbon_peak.rating").alias("direct_carbon_rating"),
        F.col("market_demand_peak.value").alias("market_demand_value"),
        F.col("market_demand_peak.year").alias("market_demand_year"),
        F.col("market_demand_peak.rating").alias("market_demand_rating"),
    )


# -- driver views over the evidence rows ------------------------------------------


def best_impact(subrisks: DataFrame, keys: Sequence[str], keep_empty: bool = False) -> DataFrame:
    """The row with the largest quantified impact per key.

    Equal impacts go to the earlier horizon, then subrisk and indicator by name,
    then file order. With ``keep_empty`` a key without any quantified row stays
    with nulls.
    """
    payload = F.struct(
        *[c for c in subrisks.columns if c not in keys and c not in file_order(subrisks)],
    )
    order = [
        F.col("horizon"),
        F.coalesce("subrisk", F.lit("")),
        F.coalesce("indicator", F.lit("")),
        *map(F.col, file_order(subrisks)),
    ]
    source = subrisks if keep_empty else subrisks.where(is_valid("adjusted_revenue_impact"))
    value = F.col("adjusted_revenue_impact")
    best = source.groupBy(*keys).agg(first_of_largest(payload, value, is_valid(value), order).alias("_best"))
    return best.select(*keys, "_best.*")


def rankings_for_driver(subrisks: DataFrame, rankings: DataFrame, driver: str = "all") -> DataFrame:
    """Scenario rankings by one driver's best row; the unfiltered peaks ride along."""
    if driver == "all":
        return rankings
    best = best_impact(filter_driver(subrisks, driver), ["asset_name", "scenario"])
    drivers = rankings.select("asset_name", "scenario", "direct_carbon_peak", "market_demand_peak")
    return best.join(drivers, ["asset_name", "scenario"], "left").select(
        "asset_name",
        "scenario",
        F.col("adjusted_revenue_impact").alias("peak_impact"),
        F.col("horizon").alias("peak_year"),
        F.col("subrisk").alias("peak_subrisk"),
        F.col("rating").alias("peak_rating"),
        "direct_carbon_peak",
        "market_demand_peak",
    )


def driver_trend(trends: DataFrame, subrisks: DataFrame, driver: str = "all") -> DataFrame:
    """One point per asset, scenario and horizon; unquantified points stay as nulls."""
    if driver == "all":
        return trends.select(
            *KEYS,
            F.col("max_adjusted_subrisk_revenue_impact").alias("impact"),
            F.col("transition_rating").alias("rating"),
            F.col("top_subrisk").alias("driver"),
            F.lit(None).cast("string").alias("indicator"),
        )
    return best_impact(filter_driver(subrisks, driver), KEYS, keep_empty=True).select(
        *KEYS,
        F.col("adjusted_revenue_impact").alias("impact"),
        "rating",
        F.col("subrisk").alias("driver"),
        "indicator",
    )


def build_transition(rows: DataFrame, order: Sequence[str] = ROW_ORDER) -> dict[str, DataFrame]:
    return {
        "scenario_rankings": scenario_rankings(rows, order),
        "trends": transition_trends(rows, order),
        "subrisks": subrisk_rows(rows, order),
    }


