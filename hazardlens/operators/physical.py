"""Physical risk: trends, hazard roll-up, worst indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.functions.numbers import comparable, float_column
from hazardlens.functions.ordering import ROW_ORDER, last_non_null
from hazardlens.functions.ratings import LETTERS, rating_letter, rating_score, worst_score
from hazardlens.functions.text import blank_to_null, first_non_blank, is_blank
from hazardlens.operators.axes import KEYS, indicator_rows, valid_axes

HAZARD_KEYS = [*KEYS, "hazard"]

# output column = returned column
TREND_METRICS = {
    "adjusted_total_damage": "adjustedTotalDamage",
    "adjusted_total_disruption": "adjustedTotalDisruption",
    "adjusted_total_disruption_damage_equivalent": "adjustedTotalDisruptionDamageEquivalent",
    "adjusted_total_value_impact": "adjustedTotalValueImpact",
}
HAZARD_METRICS = {
    "adjusted_hazard_damage": "adjustedHazardDamage",
    "adjusted_hazard_disruption": "adjustedHazardDisruption",
    "adjusted_hazard_disruption_damage_equivalent": "adjustedHazardDisruptionDamageEquivalent",
    "adjusted_hazard_value_impact": "adjustedHazardValueImpact",
}


def physical_trends(rows: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """Total metrics per asset, scenario and horizon.

    The metrics repeat on every indicator row, so a sum would count them many
    times: the last quantified row in file order speaks for the group. The rating
    is the worst one of the rows.
    """
    base = valid_axes(rows)
    metrics = [
        last_non_null(float_column(base, source), order).alias(name) for name, source in TREND_METRICS.items()
    ]
    rating = first_non_blank("adjustedPhysicalExposureRating", "physicalExposureRating")
    return (
        base.groupBy(*KEYS)
        .agg(*metrics, F.max(rating_score(rating)).alias("_score"))
        .withColumn("adjusted_physical_exposure_rating", rating_letter("_score"))
        .drop("_score")
    )


def hazard_rollup(rows: DataFrame) -> DataFrame:
    """Largest metrics, worst rating and indicator-rating counts per hazard.

    Counts take the exact letters only; the hazard rating also reads ``" a"``.
    """
    base = valid_axes(rows).where(~is_blank("hazard"))
    metrics = [
        F.max(comparable(float_column(base, source))).alias(name) for name, source in HAZARD_METRICS.items()
    ]
    score = worst_score("adjustedHazardExposureRating", "hazardExposureRating", "HazardRating")
    counts = [F.count_if(F.col("indicatorRating") == letter).alias(f"rating_{letter}") for letter in LETTERS]
    return (
        base.groupBy(*HAZARD_KEYS)
        .agg(*metrics, F.max(score).alias("_score"), *counts)
        .withColumn("hazard_rating", rating_letter("_score"))
        .select(*HAZARD_KEYS, *HAZARD_METRICS, "hazard_rating", *[f"rating_{x}" for x in LETTERS])
    )


def worst_indicators(rows: DataFrame, k: int = 3, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """The ``k`` worst indicators per hazard, by rating and then by value.

    Units differ between indicators, so the value only breaks ties of the rating.
    Missing values come last and equal rows keep file order. Spark cuts every
    input partition to ``k`` rows per hazard before the shuffle.
    """
    base = valid_axes(rows).where(~is_blank("hazard"))
    number = float_column(base, "indicatorValue")
    value = F.coalesce(comparable(number), F.lit(float("-inf")))
    rank = Window.partitionBy(*HAZARD_KEYS).orderBy(
        F.col("_score").desc(), F.col("_value").desc(), *[F.col(c).asc() for c in order]
    )
    return (
        base.select(
            *HAZARD_KEYS,
            "indicator",
            number.alias("value"),
            blank_to_null("indicatorUnit").alias("unit"),
            blank_to_null("indicatorRating").alias("rating"),
            rating_score("indicatorRating").alias("_score"),
            value.alias("_value"),
            *order,
        )
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select(*HAZARD_KEYS, "rank", "indicator", "value", "unit", "rating")
    )


def hazards(rows: DataFrame, k: int = 3, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """The hazard roll-up with its worst indicators and rating counts nested."""
    # at most k rows per hazard reach the list
    worst = (
        worst_indicators(rows, k, order)
        .groupBy(*HAZARD_KEYS)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "indicator", "value", "unit", "rating"))).alias("_w"))
        .withColumn("worst_indicators", F.transform("_w", lambda w: w.dropFields("rank")))
        .drop("_w")
    )
    rollup = hazard_rollup(rows)
    nested = rollup.select(
        *HAZARD_KEYS,
        *HAZARD_METRICS,
        "hazard_rating",
        F.struct(*[F.col(f"rating_{x}").alias(x) for x in LETTERS]).alias("indicator_rating_counts"),
    )
    return nested.join(worst, HAZARD_KEYS, "left")


def build_physical(rows: DataFrame, order: Sequence[str] = ROW_ORDER) -> dict[str, DataFrame]:
    return {
        "trends": physical_trends(rows, order),
        "hazards": hazards(rows, order=order),
        "indicators": indicator_rows(rows, order),
    }
