"""Change, share, rank and scaling along trend series.

These windows run over aggregated rows: a series has one row per horizon and a
view one row per hazard or scenario, so no window sees raw result rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.functions.numbers import is_valid

SERIES = ("asset_name", "scenario")


def percent_change(value: Column, base: Column) -> Column:
    """Percent change to one decimal; null when either side is null or zero."""
    usable = is_valid(value) & is_valid(base) & (value != 0) & (base != 0)
    return F.when(usable, F.round((value / base - 1) * 100, 1))


def change_from_first(
    trends: DataFrame, col: str = "adjusted_total_value_impact", keys: Sequence[str] = SERIES
) -> DataFrame:
    """Adds the percent change from the series' first horizon, null first values included."""
    first = F.first_value(col).over(Window.partitionBy(*keys).orderBy("horizon"))
    return trends.withColumn("change_pct", percent_change(F.col(col), first))


def horizon_delta(
    trends: DataFrame, col: str = "adjusted_total_value_impact", keys: Sequence[str] = SERIES
) -> DataFrame:
    """Adds the step from the previous horizon and the change of that step."""
    series = Window.partitionBy(*keys).orderBy("horizon")
    stepped = trends.withColumn("delta", F.col(col) - F.lag(col).over(series))
    return stepped.withColumn("acceleration", F.col("delta") - F.lag("delta").over(series))


def bar_share(view: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Adds each row's share of the view's largest value; zero when nothing is positive."""
    value = F.coalesce(F.when(is_valid(col), F.col(col)), F.lit(0.0))
    largest = F.max(value).over(Window.partitionBy(*keys))
    return view.withColumn("bar_share", F.when(largest > 0, value / largest).otherwise(0.0))


def rank_position(view: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return view.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def scaled_series(
    trends: DataFrame,
    col: str = "adjusted_total_value_impact",
    keys: Sequence[str] = SERIES,
    levels: int = 8,
) -> DataFrame:
    """Adds the value's level 0..levels-1 between the series' minimum and maximum."""
    series = Window.partitionBy(*keys)
    value = F.when(is_valid(col), F.col(col))
    low, high = F.min(value).over(series), F.max(value).over(series)
    level = F.when(high > low, F.floor((value - low) / (high - low) * (levels - 1))).otherwise(
        F.when(value.isNotNull(), F.lit(0))
    )
    return trends.withColumn("level", level.cast("int"))


def trend_summary(
    trends: DataFrame, col: str = "adjusted_total_value_impact", keys: Sequence[str] = SERIES
) -> DataFrame:
    """Extent, peak, first and last value and overall change of each series, in one pass."""
    value = F.when(is_valid(col), F.col(col))
    present = value.isNotNull()
    horizon = F.col("horizon")
    rank = F.struct((-value).alias("v"), horizon.alias("h"))
    return (
        trends.groupBy(*keys)
        .agg(
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
            F.min_by(horizon, F.when(present, rank)).alias("peak_horizon"),
            F.min(horizon).alias("first_horizon"),
            F.max(horizon).alias("last_horizon"),
            F.min_by(value, horizon).alias("first_value"),
            F.max_by(value, horizon).alias("last_value"),
        )
        .withColumn("change_pct", percent_change(F.col("last_value"), F.col("first_value")))
    )


def top_rows(table: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows per key with their position; partitions are cut before the shuffle."""
    rank = Window.partitionBy(*keys).orderBy(*order)
    return table.withColumn("position", F.row_number().over(rank)).where(F.col("position") <= k)
