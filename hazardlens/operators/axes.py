"""Row axes: which result rows count, and slices along asset, scenario, horizon, driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.numbers import float_column, int_column, is_valid
from hazardlens.functions.ordering import ROW_ORDER
from hazardlens.functions.text import blank_to_null, first_non_blank, is_blank

KEYS = ["asset_name", "scenario", "horizon"]

# fixed values: the slice a report opens with
PREFERRED_PHYSICAL_SCENARIO = "ssp5-8.5"
PREFERRED_HORIZON = 2100
PREFERRED_TRANSITION_SCENARIO = "Net Zero 2050"


def valid_axes(rows: DataFrame) -> DataFrame:
    """Rows that name an asset, a scenario and a whole-year horizon.

    Adds ``asset_name`` and ``horizon``; rows of the ``Historical`` horizon go.
    """
    return rows.where(~is_blank("assetName") & ~is_blank("scenario")).withColumns(
        {"asset_name": F.col("assetName"), "horizon": int_column(rows, "timeHorizon")}
    ).where(F.col("horizon").isNotNull())


future_only = valid_axes


def optional_text(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def asset_context(rows: DataFrame) -> list[Column]:
    """The seven identity columns under their report names."""
    names = {
        "asset_name": "assetName",
        "scr_asset_id": "assetId",
        "coordinates": "geolocationCoordinates",
        "country_code": "countryCode",
        "climate_zone": "climateZone",
        "ticcs_sub_class": "ticcsSubClass",
        "ticcs_sub_class_name": "ticcsSubClassName",
    }
    return [optional_text(rows, source).alias(name) for name, source in names.items()]


def indicator_rows(rows: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """One evidence row per valid physical row, with or without a hazard, and its place."""
    base = valid_axes(rows)
    return base.select(
        *KEYS,
        "hazard",
        "indicator",
        float_column(base, "indicatorValue").alias("value"),
        blank_to_null("indicatorUnit").alias("unit"),
        blank_to_null("indicatorRating").alias("rating"),
        *order,
    )


def subrisk_rows(rows: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """One evidence row per valid transition row, and its place."""
    base = valid_axes(rows)
    return base.select(
        *KEYS,
        "indicator",
        float_column(base, "indicatorValue").alias("indicator_value"),
        blank_to_null("indicatorUnit").alias("indicator_unit"),
        "subrisk",
        float_column(base, "adjustedSubriskRevenueImpact").alias("adjusted_revenue_impact"),
        first_non_blank("adjustedSubriskExposureRating", "subriskExposureRating").alias("rating"),
        *order,
    )


# -- slices --------------------------------------------------------------------


def slice_asset(table: DataFrame, assets: DataFrame, asset: str, keep_unnamed: bool = False) -> DataFrame:
    """Rows of one asset; an unknown name falls back to the first asset by name."""
    chosen = assets.agg(
        F.coalesce(
            F.max(F.when(F.col("asset_name") == asset, F.col("asset_name"))), F.min("asset_name")
        ).alias("_chosen")
    )
    match = F.col("asset_name") == F.col("_chosen")
    if keep_unnamed:
        match = match | is_blank("asset_name")
    # one row by construction, so the broadcast is bounded
    return table.join(F.broadcast(chosen), match, "left_semi")


def slice_view(table: DataFrame, scenario: str, horizon: int) -> DataFrame:
    return table.where((F.col("scenario") == scenario) & (F.col("horizon") == horizon))


def filter_driver(subrisks: DataFrame, driver: str = "all") -> DataFrame:
    return subrisks if driver == "all" else subrisks.where(F.col("subrisk") == driver)


def rated(table: DataFrame, col: str = "rating") -> DataFrame:
    return table.where(~is_blank(col))


def quantified(table: DataFrame, col: str) -> DataFrame:
    return table.where(is_valid(col))


def options(table: DataFrame, col: str) -> DataFrame:
    """Distinct choices of a control, blanks left out."""
    kept = table.where(F.col(col).isNotNull())
    if dict(table.dtypes)[col] == "string":
        kept = kept.where(F.col(col) != "")
    return kept.select(col).distinct()


def _first_present(col: str, wanted: Sequence, fallback: Column) -> Column:
    """The first wanted value that occurs in the group."""
    found = [F.max(F.when(F.col(col) == value, F.col(col))) for value in wanted if value is not None]
    return F.coalesce(*found, fallback).alias(col)


def default_physical_slice(
    trends: DataFrame,
    scenarios: Sequence[str | None] = (PREFERRED_PHYSICAL_SCENARIO,),
    horizons: Sequence[int | None] = (PREFERRED_HORIZON,),
) -> DataFrame:
    """Per asset: the first wanted scenario and horizon it has, else its first scenario and last horizon."""
    return trends.groupBy("asset_name").agg(
        _first_present("scenario", scenarios, F.min("scenario")),
        _first_present("horizon", horizons, F.max("horizon")),
    )


def default_transition_slice(
    rankings: DataFrame, scenario: str = PREFERRED_TRANSITION_SCENARIO
) -> DataFrame:
    """Per asset: the wanted scenario, else the one with the highest peak."""
    return rankings.groupBy("asset_name").agg(
        F.coalesce(
            F.max(F.when(F.col("scenario") == scenario, F.col("scenario"))),
            F.min_by("scenario", F.struct(-F.col("peak_impact"), F.col("scenario"))),
        ).alias("scenario")
    )


def keep_or_default(options_table: DataFrame, requested, default: DataFrame, col: str) -> DataFrame:
    """Per asset: the requested value where the asset has it, else its default."""
    has = (
        options_table.where(F.col(col) == requested)
        .select("asset_name", F.lit(requested).alias("_kept"))
        .distinct()
    )
    return default.join(has, "asset_name", "left").select(
        "asset_name", F.coalesce("_kept", F.col(col)).alias(col)
    )
