"""One query per operator, bound to the check tables. Results are flat and fully named."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.functions import display, numbers, ratings, text
from hazardlens.operators import (
    assets,
    axes,
    export,
    joins,
    physical,
    portfolio,
    quality,
    registry,
    response,
    runs,
    series,
    sidecar,
    transition,
    validity,
    vocabulary,
)
from hazardlens.plans import driver_views as v
from hazardlens.plans import import_run, incremental, reports, result_build
from hazardlens.schemas import MANIFEST_COLUMNS, UPLOAD_KEYS
from hazardlens.sinks import clustered, writers
from hazardlens.sinks.history import History
from hazardlens.sources import quoted, tables, workbooks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PLAIN = export.ExportOptions("run_check", "2026-07-01T00:00:00+00:00", "2026", asset_value_source="capex_proxy")
STRICT = export.ExportOptions(
    "run_check",
    "2026-07-01T00:00:00+00:00",
    "2026",
    strict=True,
    require_asset_value=True,
    detention_rate="0.5",
    include_operating_entity=True,
    max_asset_name_length=120,
)
HORIZONS = ["Historical", "2025", "2050", "2075", "2100"]
PHYSICAL_SCENARIOS = ["ssp2-4.5", "ssp5-8.5"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _results(spark, sf) -> reports.Results:
    return _results_of(v.physical(spark, sf), v.transition(spark, sf))


def _results_of(phys, trans) -> reports.Results:
    return reports.Results(
        assets.assets(phys, trans),
        physical.physical_trends(phys),
        physical.hazard_rollup(phys),
        axes.indicator_rows(phys),
        transition.scenario_rankings(trans),
        transition.transition_trends(trans),
        axes.subrisk_rows(trans),
    )


def _manifest(spark, sf) -> DataFrame:
    return assets.dedupe_manifest(v.manifest(spark, sf))


# -- physical and transition results -------------------------------------------------


@query
def valid_axes(spark, sf):
    return axes.valid_axes(v.physical(spark, sf)).select("seq", "asset_name", "scenario", "horizon")


@query
def indicator_rows(spark, sf):
    return axes.indicator_rows(v.physical(spark, sf))


@query
def subrisk_rows(spark, sf):
    return axes.subrisk_rows(v.transition(spark, sf))


@query
def physical_trends(spark, sf):
    return physical.physical_trends(v.physical(spark, sf))


@query
def hazard_rollup(spark, sf):
    return physical.hazard_rollup(v.physical(spark, sf))


@query
def hazard_rating_counts(spark, sf):
    nested = physical.hazards(v.physical(spark, sf))
    return nested.select(*physical.HAZARD_KEYS, "indicator_rating_counts.*", F.size("worst_indicators").alias("shown"))


@query
def worst_indicators(spark, sf):
    return physical.worst_indicators(v.physical(spark, sf))


@query
def transition_trends(spark, sf):
    return transition.transition_trends(v.transition(spark, sf))


@query
def subrisk_peaks(spark, sf):
    return transition.subrisk_peaks(v.transition(spark, sf))


@query
def scenario_rankings(spark, sf):
    return transition.flat_rankings(transition.scenario_rankings(v.transition(spark, sf)))


@query
def driver_rankings(spark, sf):
    trans = v.transition(spark, sf)
    ranked = transition.rankings_for_driver(
        axes.subrisk_rows(trans), transition.scenario_rankings(trans), transition.MARKET_DEMAND
    )
    return ranked.select(
        "asset_name",
        "scenario",
        "peak_impact",
        "peak_year",
        "peak_subrisk",
        "peak_rating",
        F.col("direct_carbon_peak.value").alias("direct_value"),
        F.col("market_demand_peak.year").alias("market_year"),
    )


@query
def best_impact_row(spark, sf):
    return transition.best_impact(axes.subrisk_rows(v.transition(spark, sf)), ["asset_name", "scenario"])


@query
def driver_trend(spark, sf):
    trans = v.transition(spark, sf)
    return transition.driver_trend(
        transition.transition_trends(trans), axes.subrisk_rows(trans), transition.DIRECT_CARBON
    )


@query
def build_meta(spark, sf):
    """Facts about a build of tables that lack some required columns."""
    phys, trans = v.physical(spark, sf), v.transition(spark, sf)
    lacking = phys.drop("climateZone", "ticcsSubClass"), trans.drop("countryCode")
    phys, trans, counts = result_build.stage_returns(*lacking)
    meta = result_build.build_meta(phys, trans, "2026-07-01", counts, physical_source="events", transition_source="orders")
    joined = {c: F.array_join(c, ",") for c in ("physical_missing", "transition_missing")}
    return meta.withColumns(joined)


# -- assets and join-back ------------------------------------------------------------


@query
def asset_first_seen(spark, sf):
    return assets.assets(v.physical(spark, sf), v.transition(spark, sf))


@query
def manifest_last_wins(spark, sf):
    return _manifest(spark, sf).select("scr_asset_name", "manifest.*")


@query
def join_back(spark, sf):
    found = assets.assets(v.physical(spark, sf), v.transition(spark, sf))
    joined = assets.join_back(found, _manifest(spark, sf))
    return joined.select(
        "asset_name",
        "scr_asset_id",
        F.col("manifest.plant_uuid").alias("plant_uuid"),
        F.col("manifest.portfolio_id").alias("portfolio_id"),
        F.col("manifest.asset_type").alias("asset_type"),
        F.col("manifest").isNotNull().alias("matched"),
    )


@query
def join_back_rows(spark, sf):
    joined = assets.join_back(v.physical(spark, sf), _manifest(spark, sf), "assetName")
    return joined.select(
        "seq", "assetName", "scenario", "hazard", F.col("manifest.portfolio_id").alias("portfolio_id")
    )


@query
def join_back_unmatched(spark, sf):
    return assets.unmatched_assets(v.physical(spark, sf), _manifest(spark, sf))


@query
def uuid_mismatches(spark, sf):
    return assets.uuid_mismatches(v.physical(spark, sf), _manifest(spark, sf))


@query
def recover_plants(spark, sf):
    return assets.recover_plants(v.transition(spark, sf), v.registry(spark, sf).plants)


@query
def portfolio_rows(spark, sf):
    trends = physical.physical_trends(v.physical(spark, sf))
    return portfolio.with_portfolio(trends, _manifest(spark, sf)).select(
        *axes.KEYS, "portfolio_id", "portfolio_asset_id", "plant_uuid", "adjusted_total_value_impact"
    )


# -- slices and options --------------------------------------------------------------


@query
def slice_unknown_asset(spark, sf):
    res = _results(spark, sf)
    return axes.slice_asset(res.trends, res.assets, "no such asset").select(
        *axes.KEYS, "adjusted_total_value_impact"
    )


@query
def slice_view(spark, sf):
    trends = physical.physical_trends(v.physical(spark, sf))
    return axes.slice_view(trends, "ssp5-8.5", 2100)


@query
def slice_from_files(spark, sf):
    """One scenario and horizon of a result set laid along a curve, with few files opened."""
    path = joins.staging_path(spark)
    # seven tables are written from them
    phys, trans = joins.staged_together(v.physical(spark, sf), v.transition(spark, sf))
    writers.write_clustered_results(_results_of(phys, trans), path, file_rows=4096)
    return tables.read_results_slice(spark, path, "ssp5-8.5", 2100).trends


@query
def slice_horizon_range(spark, sf):
    """Evidence of a range of horizons, whatever the scenario."""
    path = joins.staging_path(spark)
    rows = axes.indicator_rows(v.physical(spark, sf))
    clustered.write_clustered(rows, path, ["scenario", "horizon", "asset_name"], file_rows=4096)
    picked = clustered.read_slice(spark, path, {"horizon": (2050, 2075)})
    return picked.select("seq", *axes.KEYS, "rating")


@query
def rated_indicators(spark, sf):
    return axes.rated(axes.indicator_rows(v.physical(spark, sf))).select("seq", "rating")


@query
def quantified_subrisks(spark, sf):
    rows = axes.filter_driver(axes.subrisk_rows(v.transition(spark, sf)), transition.DIRECT_CARBON)
    return axes.quantified(rows, "adjusted_revenue_impact").select("seq", "subrisk", "adjusted_revenue_impact")


@query
def scenario_options(spark, sf):
    return axes.options(v.transition(spark, sf), "scenario")


@query
def driver_options(spark, sf):
    return axes.options(axes.subrisk_rows(v.transition(spark, sf)), "subrisk")


@query
def horizon_options(spark, sf):
    return axes.options(physical.physical_trends(v.physical(spark, sf)), "horizon")


@query
def default_physical_slice(spark, sf):
    return axes.default_physical_slice(physical.physical_trends(v.physical(spark, sf)))


@query
def default_transition_slice(spark, sf):
    ranked = transition.scenario_rankings(v.transition(spark, sf))
    return axes.default_transition_slice(ranked, "Fragmented World")


@query
def kept_horizon(spark, sf):
    trends = physical.physical_trends(v.physical(spark, sf))
    default = axes.default_physical_slice(trends).select("asset_name", "horizon")
    return axes.keep_or_default(trends, 2050, default, "horizon")


# -- response, series ----------------------------------------------------------------


@query
def static_hazards(spark, sf):
    return response.static_hazard(physical.hazard_rollup(v.physical(spark, sf)))


@query
def flat_series(spark, sf):
    hazards = physical.hazard_rollup(v.physical(spark, sf))
    return response.is_flat(hazards, ["asset_name", "scenario", "hazard"], "adjusted_hazard_value_impact")


@query
def response_points(spark, sf):
    phys = v.physical(spark, sf)
    return response.response_points(axes.indicator_rows(phys), physical.hazard_rollup(phys))


@query
def magnitude_response(spark, sf):
    phys = v.physical(spark, sf)
    return response.magnitude_response(axes.indicator_rows(phys), physical.hazard_rollup(phys), k=2)


@query
def hazard_curves_long(spark, sf):
    return reports.hazard_curves(physical.hazard_rollup(v.physical(spark, sf)))


@query
def change_from_first(spark, sf):
    trends = physical.physical_trends(v.physical(spark, sf))
    return series.change_from_first(trends).select(*axes.KEYS, "adjusted_total_value_impact", "change_pct")


@query
def horizon_delta(spark, sf):
    trends = physical.physical_trends(v.physical(spark, sf))
    return series.horizon_delta(trends).select(*axes.KEYS, "delta", "acceleration")


@query
def bar_share(spark, sf):
    hazards = physical.hazard_rollup(v.physical(spark, sf))
    return series.bar_share(hazards, axes.KEYS, "adjusted_hazard_value_impact").select(
        *physical.HAZARD_KEYS, "bar_share"
    )


@query
def scaled_series(spark, sf):
    trends = physical.physical_trends(v.physical(spark, sf))
    return series.scaled_series(trends).select(*axes.KEYS, "level")


@query
def trend_summary(spark, sf):
    return series.trend_summary(physical.physical_trends(v.physical(spark, sf)))


# -- quality -------------------------------------------------------------------------


@query
def grain_violations(spark, sf):
    return quality.check_grain(v.physical(spark, sf), quality.PHYSICAL_GRAIN)


@query
def repeat_inconsistency(spark, sf):
    return quality.check_repeats(
        v.transition(spark, sf),
        ["assetName", "scenario", "timeHorizon"],
        ["adjustedSubriskRevenueImpact", "countryCode", "climateZone"],
    )


@query
def value_identity(spark, sf):
    return quality.check_value_identity(v.physical(spark, sf)).select("seq", "assetName", "hazard", "difference")


@query
def id_drift(spark, sf):
    return quality.id_drift(v.history(spark, sf))


@query
def coordinate_grain(spark, sf):
    points = v.physical(spark, sf).select(
        F.col("assetName"),
        F.when(F.col("seq") % 40 != 0, F.lit(1.5)).alias("lat"),
        F.when(F.col("seq") % 3 == 0, F.lit(2.5)).otherwise(F.length("assetId") * 1.0).alias("lon"),
    )
    return quality.coordinate_grain(points, "assetName")


@query
def vocabulary_status(spark, sf):
    return vocabulary.vocabulary_status(v.physical(spark, sf), "hazard", v.vocabulary(spark, sf))


@query
def vocabulary_unused(spark, sf):
    return vocabulary.unused_terms(v.physical(spark, sf), "hazard", v.vocabulary(spark, sf))


@query
def scenario_category(spark, sf):
    rows = v.transition(spark, sf).withColumn("scenario", F.upper("scenario"))
    return vocabulary.with_scenario_category(rows).select(
        "seq", "scenario", "scenario_category", "physical_scenario"
    )


@query
def driver_labels(spark, sf):
    rows = axes.subrisk_rows(v.transition(spark, sf))
    return rows.select("seq", "subrisk", display.driver_label("subrisk").alias("label"))


@query
def display_labels(spark, sf):
    labels = v.vocabulary(spark, sf).select(
        F.initcap("term").alias("raw"), F.concat(F.lit("Hazard: "), F.initcap("term")).alias("label")
    )
    return vocabulary.display_label(v.physical(spark, sf).select("seq", "hazard"), "hazard", labels)


@query
def coverage(spark, sf):
    families = {
        "totals": ["adjustedTotalDamage", "adjustedTotalDisruption", "adjustedTotalValueImpact"],
        "hazard": ["adjustedHazardDamage", "adjustedHazardValueImpact"],
        "ratings": ["hazardExposureRating", "adjustedHazardExposureRating", "HazardRating"],
        "indicator": ["indicatorValue", "indicatorUnit", "indicatorRating"],
        "absent": ["totalDamage"],
    }
    return quality.coverage(v.physical(spark, sf), families)


@query
def rating_distribution(spark, sf):
    return quality.rating_distribution(v.physical(spark, sf), "indicatorRating", ["scenario"])


@query
def row_mix(spark, sf):
    return quality.row_mix(v.physical(spark, sf), "hazard")


@query
def row_matrix(spark, sf):
    return quality.row_matrix(v.physical(spark, sf), HORIZONS)


@query
def subrisk_matrix(spark, sf):
    peaks = transition.subrisk_peaks(v.transition(spark, sf))
    return quality.subrisk_matrix(peaks, [transition.DIRECT_CARBON, transition.MARKET_DEMAND])


@query
def manifest_differences(spark, sf):
    found = assets.assets(v.physical(spark, sf), v.transition(spark, sf))
    uploaded = v.manifest(spark, sf).select(
        "scr_asset_name",
        F.lit("USA").alias("country_code"),
        F.when(F.col("seq") % 4 == 0, "IC1010").otherwise("IC2010").alias("ticcs_class"),
    )
    return quality.compare_with_manifest(found, _manifest(spark, sf), uploaded.distinct())


@query
def import_summary(spark, sf):
    return quality.import_summary(v.history(spark, sf), _manifest(spark, sf))


@query
def latest_import(spark, sf):
    latest = quality.latest_import(v.history(spark, sf))
    return latest.select("seq", "assetName", "import_id", "imported_at")


@query
def import_failures(spark, sf):
    phys = v.physical(spark, sf)
    headers = phys.groupBy("source_file").agg(
        F.when(F.col("source_file") == "physical_1", F.array(F.lit("assetName"), F.lit("scenario")))
        .otherwise(F.array(F.lit("assetName"), F.lit("hazard")))
        .alias("columns"),
        F.when(F.col("source_file") == "physical_2", F.lit("no sheet Output")).alias("error"),
    )
    return quality.import_failures(headers, phys, _manifest(spark, sf))


@query
def import_warnings(spark, sf):
    phys = v.physical(spark, sf)
    found = assets.assets(phys, v.transition(spark, sf))
    differences = quality.compare_with_manifest(found, _manifest(spark, sf))
    return quality.import_warnings(
        phys,
        {"hazard": v.vocabulary(spark, sf)},
        ["indicatorValue", "adjustedHazardValueImpact", "adjustedTotalValueImpact"],
        ["totalDamage", "adjustedTotalDamage"],
        v.history(spark, sf),
        differences,
    )


@query
def output_kind(spark, sf):
    rows = v.physical(spark, sf).select(
        "source_file",
        F.when(F.col("seq") % 3 == 0, F.array(F.lit("assetName"), F.lit("hazard")))
        .when(F.col("seq") % 3 == 1, F.array(F.lit("subrisk"), F.lit("scenario")))
        .otherwise(F.array(F.lit("scenario")))
        .alias("columns"),
    )
    return rows.select("source_file", quality.kind_column(F.col("columns")).alias("kind")).groupBy(
        "source_file", "kind"
    ).agg(F.count("*").alias("n"))


# -- portfolio -----------------------------------------------------------------------


def _portfolio_view(spark, sf):
    res = _results(spark, sf)
    rows = portfolio.with_portfolio(res.trends, _manifest(spark, sf))
    sector = res.assets.select("asset_name", "ticcs_sub_class")
    return axes.slice_view(rows, "ssp2-4.5", 2050).join(sector, "asset_name", "left")


@query
def portfolio_rating(spark, sf):
    rows = portfolio.with_portfolio(physical.physical_trends(v.physical(spark, sf)), _manifest(spark, sf))
    return portfolio.portfolio_rating(
        rows, ["portfolio_id", "scenario", "horizon"], "adjusted_physical_exposure_rating"
    )


@query
def portfolio_rollup(spark, sf):
    return portfolio.portfolio_rollup(
        _portfolio_view(spark, sf), "adjusted_physical_exposure_rating", "adjusted_total_value_impact"
    )


@query
def portfolio_top_assets(spark, sf):
    top = portfolio.top_exposed_assets(
        _portfolio_view(spark, sf), "adjusted_physical_exposure_rating", "adjusted_total_value_impact", 2
    )
    return top.select("portfolio_id", "position", "asset_name", "adjusted_total_value_impact")


@query
def portfolio_top_hazards(spark, sf):
    hazards = portfolio.with_portfolio(physical.hazard_rollup(v.physical(spark, sf)), _manifest(spark, sf))
    return portfolio.top_drivers(hazards, "hazard", "adjusted_hazard_value_impact", 3)


@query
def portfolio_scenarios(spark, sf):
    rows = portfolio.with_portfolio(physical.physical_trends(v.physical(spark, sf)), _manifest(spark, sf))
    return portfolio.scenario_comparison(
        rows, PHYSICAL_SCENARIOS, "adjusted_total_value_impact", ["portfolio_id", "horizon"]
    )


# -- reports -------------------------------------------------------------------------


@query
def asset_kpis(spark, sf):
    return reports.asset_kpis(_results(spark, sf))


@query
def physical_trend_series(spark, sf):
    return reports.physical_trend_series(
        physical.physical_trends(v.physical(spark, sf)), "disruption", "basis_points"
    )


@query
def hazard_ranking(spark, sf):
    ranked = reports.hazard_ranking(physical.hazard_rollup(v.physical(spark, sf)))
    return ranked.select(
        *physical.HAZARD_KEYS, "position", "hazard_rating", "band", "bar_share", "is_static", "label"
    )


@query
def top_indicators(spark, sf):
    return reports.indicator_table(axes.indicator_rows(v.physical(spark, sf)))


@query
def transition_ranking(spark, sf):
    trans = v.transition(spark, sf)
    return reports.transition_ranking(axes.subrisk_rows(trans), transition.scenario_rankings(trans))


@query
def top_subrisks(spark, sf):
    return reports.subrisk_table(axes.subrisk_rows(v.transition(spark, sf)))


@query
def interpretation(spark, sf):
    return reports.interpretation(_results(spark, sf), scenario="ssp2-4.5", horizon=2075).select(
        "asset_name", "change_pct", "physical_text", "transition_text"
    )


@query
def physical_summary(spark, sf):
    return reports.physical_summary(_results(spark, sf))


@query
def transition_summary(spark, sf):
    return reports.transition_summary(_results(spark, sf))


@query
def driver_split(spark, sf):
    return reports.driver_split(transition.scenario_rankings(v.transition(spark, sf)))


@query
def scenario_compare(spark, sf):
    return reports.scenario_compare(physical.physical_trends(v.physical(spark, sf)), PHYSICAL_SCENARIOS)


# -- registry and export ---------------------------------------------------------------


def _scope_text(scope: DataFrame) -> DataFrame:
    return scope.withColumns(
        {
            **{c: numbers.decimal_text(c) for c in ("latitude", "longitude", "total_capacity_mw", "latest_capex_per_kw")},
            "fuel_types": text.pipe_join("fuel_types"),
            "technologies": text.pipe_join("technologies"),
        }
    )


@query
def scope_reference(spark, sf):
    return _scope_text(registry.scope_reference(v.registry(spark, sf)))


@query
def scope_portfolio(spark, sf):
    return _scope_text(registry.scope_portfolio(v.registry(spark, sf)))


@query
def scope_workspace(spark, sf):
    return _scope_text(registry.scope_workspace(v.registry(spark, sf), state="all"))


@query
def scope_workspace_portfolio(spark, sf):
    scope = registry.scope_workspace(v.registry(spark, sf), "ws_1", "portfolio")
    return scope.select("plant_uuid", "workspace_slug", "portfolio_id", "portfolio_asset_id")


@query
def scope_plants(spark, sf):
    reg = v.registry(spark, sf)
    ids = v.table(spark, sf, "orders").select(v.plant_uuid(F.col("o_custkey")).alias("id"))
    scope = registry.scope_plants(reg, ids)
    return scope.select(
        "plant_uuid", "workspace_id", "workspace_slug", "workspace_asset_state", "portfolio_id", "portfolio_asset_id"
    )


@query
def live_portfolios(spark, sf):
    return registry.list_portfolios(v.registry(spark, sf).portfolio, "ws_2").select("id", "name", "created_at")


def _exported(spark, sf, opts):
    reg = v.registry(spark, sf)
    return export.export_rows(
        registry.scope_portfolio(reg),
        sidecar.index_sidecar(v.sidecar(spark, sf)),
        v.asset_types(spark, sf),
        v.country_codes(spark, sf),
        opts,
        registry.plant_records(reg),
    )


@query
def sidecar_priority(spark, sf):
    scope = registry.scope_workspace(v.registry(spark, sf), state="all")
    named = scope.withColumn("scr_asset_name", text.asset_name("plant_uuid", "plant_slug", "plant_name"))
    found = sidecar.resolve_sidecar(named, sidecar.index_sidecar(v.sidecar(spark, sf)))
    return found.select(
        "plant_uuid",
        "portfolio_asset_id",
        F.col("side.asset_value").alias("side_value"),
        F.col("side.revenues").alias("side_revenues"),
        F.col("side.eia_plant_id").alias("side_eia"),
    )


@query
def manifest_rows(spark, sf):
    return export.manifest_rows(_exported(spark, sf, PLAIN), PLAIN).select(*MANIFEST_COLUMNS)


@query
def upload_values(spark, sf):
    return export.upload_values(export.accepted(_exported(spark, sf, STRICT))).select(*UPLOAD_KEYS)


@query
def export_validation(spark, sf):
    rows = _exported(spark, sf, STRICT)
    return rows.select(
        "portfolio_asset_id",
        "plant_uuid",
        text.pipe_join("errors").alias("errors"),
        text.pipe_join("warnings").alias("warnings"),
    )


@query
def rejects(spark, sf):
    return export.rejected(_exported(spark, sf, PLAIN)).select("portfolio_asset_id", "plant_uuid")


@query
def warning_counts(spark, sf):
    return runs.count_messages(_exported(spark, sf, PLAIN), "warnings")


@query
def error_counts(spark, sf):
    return runs.count_messages(_exported(spark, sf, STRICT), "errors")


@query
def run_summary(spark, sf):
    return runs.job_status(runs.run_totals(_exported(spark, sf, STRICT)))


@query
def preupload_check(spark, sf):
    return runs.preupload_check(_exported(spark, sf, PLAIN))


@query
def upload_batches(spark, sf):
    named = export.accepted(_exported(spark, sf, PLAIN)).select(
        "workspace_slug", "portfolio_name", "plant_slug", "plant_uuid", "portfolio_asset_id", "scr_asset_name"
    )
    batches = runs.batch_uploads(named, registry.export_order())
    return batches.select("portfolio_asset_id", "scr_asset_name", "row_number", "batch_id")


# -- files -----------------------------------------------------------------------------


def _file_rows(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns if c != key])


@query
def upload_file(spark, sf):
    path = joins.staging_path(spark)
    writers.write_upload(_exported(spark, sf, STRICT), path)
    return _file_rows(spark.read.csv(path, header=True, escape='"'), "Asset Name")


@query
def upload_batch_files(spark, sf):
    path = joins.staging_path(spark)
    writers.write_upload_batches(_exported(spark, sf, PLAIN), path)
    rows = spark.read.csv(path, header=True, escape='"').select(
        F.col("batch_id").cast("int").alias("batch_id"), F.col("_metadata.file_path").alias("file")
    )
    return rows.groupBy("batch_id").agg(F.count("*").alias("n"), F.count_distinct("file").alias("n_files"))


@query
def manifest_file(spark, sf):
    path = joins.staging_path(spark)
    # two files are written from it
    exported = joins.staged(_exported(spark, sf, PLAIN))
    writers.write_manifest(exported, f"{path}/manifest", PLAIN)
    writers.write_rejects(exported, f"{path}/rejects", PLAIN)
    kept = tables.read_manifest(spark, f"{path}/manifest")
    rejects = tables.read_manifest(spark, f"{path}/rejects")
    return kept.join(rejects.select("scr_asset_name", F.lit(True).alias("r")), "scr_asset_name", "left").select(
        "scr_asset_name",
        F.col("manifest.plant_uuid").alias("plant_uuid"),
        F.col("manifest.plant_name").alias("plant_name"),
        F.col("manifest.latitude").alias("latitude"),
        F.coalesce("r", F.lit(False)).alias("has_reject"),
    )


@query
def sidecar_file(spark, sf):
    """Sidecar rows through a file whose headers are spelled the way users spell them."""
    path = joins.staging_path(spark)
    spelled = v.sidecar(spark, sf).select(
        F.col("plant_uuid").alias("Plant ID"),
        F.col("eia_plant_id").alias("EIA Plant-ID"),
        F.concat(F.lit(" "), "asset_value", F.lit(" ")).alias("Asset Value (USD)"),
        F.lit("0").alias("Revenue"),
        F.col("revenues").alias("Annual Revenue USD"),
        F.col("operating_entity_name").alias("Operator"),
        F.col("seq").cast("string").alias("Row No"),
    )
    # half the rows in files with the columns the other way round
    half = F.col("Row No").cast("long") % 2 == 0
    spelled.where(half).write.csv(path, **writers.CSV_OPTIONS)
    spelled.where(~half).select(*reversed(spelled.columns)).select(
        "Revenue", *[c for c in reversed(spelled.columns) if c != "Revenue"]
    ).write.mode("append").csv(path, **writers.CSV_OPTIONS)
    return tables.read_sidecar(spark, path).select(
        "plant_uuid", "eia_plant_id", "asset_value", "revenues", "operating_entity_name", "address", "row_no"
    )


@query
def long_results_csv(spark, sf):
    path = joins.staging_path(spark)
    v.transition(spark, sf).drop("seq", "source_file").withColumn("row_key", F.col("indicatorValue")).write.csv(
        path, **writers.CSV_OPTIONS
    )
    rows = tables.read_long(spark, path, fmt="csv")
    return rows.select(
        "assetName",
        "scenario",
        "timeHorizon",
        F.coalesce("subrisk", F.lit("")).alias("subrisk"),
        "indicatorValue",
        "adjustedSubriskRevenueImpact",
        "subriskRevenueImpact",
        F.col("row_key").cast("double").alias("row_key"),
    )


@query
def result_set(spark, sf):
    """A result build written as tables, opened again, and sliced by one scenario."""
    path = joins.staging_path(spark)
    phys, trans = (
        rows.withColumn("reportDate", F.lit(None).cast("string"))
        for rows in (v.physical(spark, sf), v.transition(spark, sf))
    )
    built = result_build.build_results(phys, trans, _manifest(spark, sf))
    writers.write_results(built, path, result_build.build_meta(phys, trans, "2026-07-01"))
    res = tables.read_results(spark, path)
    worst = res.hazards.where(F.col("scenario") == "ssp5-8.5")
    return worst.select(
        *physical.HAZARD_KEYS,
        "hazard_rating",
        "adjusted_hazard_value_impact",
        F.col("worst_indicators")[0]["indicator"].alias("worst_indicator"),
        F.col("indicator_rating_counts.A").alias("n_a"),
    ).join(res.assets.select("asset_name", F.col("manifest.portfolio_id").alias("portfolio_id")), "asset_name", "left")


def _two_imports(spark, sf) -> History:
    """A history of two imports of the same rows, one of them run twice."""
    folder = joins.staging_path(spark)
    manifest = _manifest(spark, sf)
    for import_id in ("first", "second", "second"):
        done = import_run.normalize_import(v.physical(spark, sf), manifest, import_id, "2026-07-01")
        summary = import_run.import_manifest(done, manifest, "physical")
        writers.write_import(folder, import_id, physical=done, summary=summary)
    return History(spark, folder)


@query
def import_history(spark, sf):
    """Two imports of the same rows, one of them run twice, kept side by side."""
    rows = _two_imports(spark, sf).read("physical_long")
    return rows.groupBy("import_id", "plant_uuid", "portfolio_asset_id").agg(F.count("*").alias("n"))


@query
def import_history_as_of(spark, sf):
    """What the history held as of each of its commits."""
    history = _two_imports(spark, sf)
    states = [
        history.read(table, version).withColumns({"version": F.lit(version), "table": F.lit(table)})
        for version in range(history.version() + 1)
        for table in ("physical_long", "import_manifest")
    ]
    counted = [rows.groupBy("version", "table", "import_id", "source_file").agg(F.count("*").alias("n")) for rows in states]
    out = counted[0]
    for other in counted[1:]:
        out = out.unionByName(other)
    return out


@query
def import_log(spark, sf):
    """Each commit's entries, and whether their counts are those of the rows they list."""
    history = _two_imports(spark, sf)
    counts = history.read("physical_long").groupBy("import_id").agg(F.count("*").alias("found"))
    log = history.entries().where("table = 'physical_long'").join(counts, "import_id")
    return log.select("version", "table", "import_id", "n_rows", (F.col("n_rows") == F.col("found")).alias("agrees"))


@query
def import_returns(spark, sf):
    """Workbooks imported in one pass over their rows: the counts of that pass beside the tables it led to."""
    folder = joins.staging_path(spark)
    named = v.physical(spark, sf).where("assetName <> ''")
    rows = workbooks.decode_returns(v.pack_workbooks(named), "physical")
    # every asset is in this manifest under its own name
    known = named.select("assetName").distinct()
    names = known.select(
        F.monotonically_increasing_id().alias("seq"),
        F.col("assetName").alias("scr_asset_name"),
        F.lit("run").alias("scr_run_id"),
        text.uuid_from_asset_name("assetName").alias("plant_uuid"),
        F.lit("m").alias("portfolio_asset_id"),
    )
    counts = import_run.import_returns(
        rows,
        assets.dedupe_manifest(names),
        "physical",
        "import",
        "2026-07-01",
        folder,
        {"hazard": v.vocabulary(spark, sf)},
        ["indicatorValue", "adjustedHazardValueImpact"],
    )
    history = History(spark, folder)
    listed = history.read("import_manifest").agg(
        F.count("*").alias("files"), F.sum("row_count").alias("rows"), F.sum("asset_count").alias("assets")
    )
    warned = history.read("import_warnings").groupBy(F.lit("warnings").alias("part"), F.col("code").alias("name"))
    manifest = listed.select(F.lit("manifest").alias("part"), F.inline(_pairs("files", "rows", "assets")))
    passed = spark.createDataFrame([("pass", *pair) for pair in counts.items()], "part string, name string, n long")
    return passed.unionByName(manifest).unionByName(warned.agg(F.count("*").alias("n")))


def _pairs(*columns):
    return F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in columns))


def _grown(spark, sf) -> reports.Results:
    """The result set after three imports, thirds of the rows, the last one first."""
    history = History(spark, joins.staging_path(spark))
    phys, trans = (rows.withColumn("source_file", F.lit("all")) for rows in (v.physical(spark, sf), v.transition(spark, sf)))
    # thirds of the range of places, so that the place in an import goes on with the place in the table;
    # as plain ranges, so that a third reads its own stretch of the file
    parts = []
    for rows in (phys, trans):
        last = rows.agg(F.max("seq")).first()[0]
        ends = [-(-n * (last + 1) // 3) for n in range(4)]
        parts.append([rows.where(F.col("seq").between(ends[n], ends[n + 1] - 1)) for n in range(3)])
    incremental.add_imports(history, [(f"import_{n}", f"2026-07-0{n + 1}", parts[0][n], parts[1][n]) for n in (2, 0, 1)])
    return incremental.results(history, _manifest(spark, sf))


@query
def result_set_incremental(spark, sf):
    """Hazards of a result set that grew by imports."""
    res = _grown(spark, sf)
    return res.hazards.select(
        *physical.HAZARD_KEYS,
        *physical.HAZARD_METRICS,
        "hazard_rating",
        *(F.get("worst_indicators", F.lit(i))["indicator"].alias(f"worst_{i + 1}") for i in range(3)),
        *(F.col(f"indicator_rating_counts.{x}").alias(f"rating_{x}") for x in ratings.LETTERS),
    ).join(res.assets.select("asset_name", F.col("manifest.portfolio_id").alias("portfolio_id")), "asset_name", "left")


@query
def trends_incremental(spark, sf):
    return _grown(spark, sf).trends


@query
def rankings_incremental(spark, sf):
    return transition.flat_rankings(_grown(spark, sf).rankings)


@query
def workbook_blank_rows(spark, sf):
    """Rows of workbooks in which blank rows stand between the others; they are no rows."""
    rows = workbooks.decode_returns(v.pack_workbooks(v.physical(spark, sf), blank_every=3), "physical")
    return workbooks.readable(rows).select(
        "source_file", F.col("seq").alias("row_in_file"), F.element_at("extra", "seq").cast("bigint").alias("seq"), "indicator"
    )


@query
def workbook_failures(spark, sf):
    """What is wrong with each returned workbook that cannot be used."""
    return workbooks.failures(workbooks.decode_returns(v.broken_workbooks(spark, sf), "physical"))


@query
def run_messages(spark, sf):
    """Message counts through the files of a run."""
    path = joins.staging_path(spark)
    writers.write_run_summary(_exported(spark, sf, STRICT), path, STRICT)
    schema = "kind string, message string, n long"
    return spark.read.schema(schema).json(f"{path}_messages")


@query
def workbook_rows(spark, sf):
    """Result rows through workbook files and the workbook reader."""
    rows = workbooks.decode_returns(v.workbook_files(spark, sf), "physical")
    return workbooks.readable(rows).select(
        F.element_at("extra", "seq").cast("bigint").alias("seq"),
        F.col("seq").alias("row_in_file"),
        F.col("source_file"),
        *[
            F.coalesce(c, F.lit("")).alias(c)
            for c in ("assetName", "scenario", "timeHorizon", "hazard", "indicator", "indicatorRating")
        ],
        "indicatorValue",
    )


# -- orders that files keep ----------------------------------------------------------------


def _paged(spark, table, order, *columns):
    """The table written in its order and read back, each row with its position."""
    path = joins.staging_path(spark)
    writers.write_ordered(table, path, order)
    return tables.read_page(spark, path).select(*columns, "position")


def _ordered(spark, table, name, *columns):
    return _paged(spark, table, result_build.report_order(table, name), *columns)


@query
def ordered_scope(spark, sf):
    ids = v.table(spark, sf, "orders").select(v.plant_uuid(F.col("o_custkey")).alias("id"))
    scope = registry.scope_plants(v.registry(spark, sf), ids)
    return _paged(spark, scope, registry.export_order(), "plant_uuid", "portfolio_asset_id")


@query
def ordered_assets(spark, sf):
    found = assets.assets(v.physical(spark, sf), v.transition(spark, sf))
    return _ordered(spark, found, "assets", "asset_name")


@query
def ordered_trends(spark, sf):
    both = {
        "physical_trends": physical.physical_trends(v.physical(spark, sf)),
        "transition_trends": transition.transition_trends(v.transition(spark, sf)),
    }
    parts = [_ordered(spark, t, n, *axes.KEYS).withColumn("table", F.lit(n)) for n, t in both.items()]
    return parts[0].unionByName(parts[1])


@query
def ordered_hazards(spark, sf):
    return _ordered(spark, physical.hazard_rollup(v.physical(spark, sf)), "physical_hazards", *physical.HAZARD_KEYS)


@query
def ordered_indicators(spark, sf):
    return _ordered(spark, axes.indicator_rows(v.physical(spark, sf)), "physical_indicators", "seq")


@query
def indicator_page(spark, sf):
    """The second hundred indicators in report order, straight from the files."""
    rows = axes.indicator_rows(v.physical(spark, sf))
    path = joins.staging_path(spark)
    writers.write_ordered(rows, path, result_build.report_order(rows, "physical_indicators"))
    return tables.read_page(spark, path, 101, 100).select("seq", "position")


@query
def ordered_subrisks(spark, sf):
    return _ordered(spark, axes.subrisk_rows(v.transition(spark, sf)), "transition_subrisks", "seq")


@query
def ordered_rankings(spark, sf):
    ranked = transition.scenario_rankings(v.transition(spark, sf))
    return _ordered(spark, ranked, "transition_scenario_rankings", "asset_name", "scenario")


@query
def ordered_points(spark, sf):
    phys = v.physical(spark, sf)
    points = response.magnitude_response(axes.indicator_rows(phys), physical.hazard_rollup(phys), k=2)
    return _ordered(spark, points, "response_points", "seq")


@query
def ordered_portfolios(spark, sf):
    """Live portfolios of every workspace, newest first."""
    listed = registry.live(v.registry(spark, sf).portfolio)
    order = [F.col("workspace_id"), *registry.portfolio_order()]
    return _paged(spark, listed, order, "workspace_id", "id").withColumnRenamed("id", "portfolio_id")


# -- files and names ---------------------------------------------------------------------


@query
def lookup_files(spark, sf):
    """Both lookups through CSV files in which keys stand twice; the later row counts."""
    path = joins.staging_path(spark)
    types, countries = v.asset_types(spark, sf), v.country_codes(spark, sf)
    older = types.withColumn("sector", F.lit('old, "quoted"'))
    older.unionByName(types).coalesce(1).write.csv(f"{path}/types", **writers.CSV_OPTIONS)
    countries.write.csv(f"{path}/countries", **writers.CSV_OPTIONS)
    found = {
        "type": tables.read_lookup_csv(spark, f"{path}/types", "asset_type").select("asset_type", "sector"),
        "country": tables.read_lookup_csv(spark, f"{path}/countries", "country").select("country", "iso3"),
    }
    parts = [rows.toDF("key", "value").withColumn("lookup", F.lit(name)) for name, rows in found.items()]
    return parts[0].unionByName(parts[1])


@query
def vocabulary_file(spark, sf):
    """Vocabulary terms through a CSV with blanks and repeats."""
    path = joins.staging_path(spark)
    term = F.when(F.col("p_partkey") % 9 == 0, "").otherwise(F.col("p_brand"))
    v.table(spark, sf, "part").select(term.alias("Term name"), "p_name").write.csv(path, **writers.CSV_OPTIONS)
    return tables.read_vocabulary(spark, path, "Term name")


@query
def resolved_names(spark, sf):
    """Workspaces by slug and portfolios by name, or why there is none."""
    reg = v.registry(spark, sf)
    # the portfolio pf_2 stands twice in its workspace
    twice = reg.portfolio.where("id = 'pf_2'").withColumn("id", F.lit("pf_2b"))
    portfolios = reg.portfolio.unionByName(twice)
    names = {r["id"]: r["name"] for r in reg.portfolio.where("id in ('pf_1', 'pf_2', 'pf_10')").collect()}

    def outcome(find, *args):
        try:
            return find(*args)
        except LookupError as error:
            return str(error).split(" ")[0]

    asked = [("workspace", slug, outcome(registry.resolve_workspace, reg.workspace, slug)) for slug in ("africa", "middle east", "mars")]
    for key, workspace in (("pf_1", "ws_1"), ("pf_2", "ws_2"), ("pf_10", "ws_0"), ("pf_1", "ws_3")):
        found = outcome(registry.resolve_portfolio, portfolios, workspace, names[key])
        asked.append(("portfolio", f"{workspace}/{key}", found))
    return spark.createDataFrame(asked, "kind string, asked string, outcome string")


@query
def error_counts_strict(spark, sf):
    """Errors of a strict run that does not ask for asset values by itself."""
    return runs.count_messages(_exported(spark, sf, replace(STRICT, require_asset_value=False)), "errors")


@query
def portfolio_top_subrisks(spark, sf):
    """Top transition drivers of each portfolio, from the portfolio report."""
    report = reports.portfolio_report(_results(spark, sf), _manifest(spark, sf), "ssp5-8.5", 2100, PHYSICAL_SCENARIOS)
    return report["top_subrisks"]


@query
def vocabulary_suggestions(spark, sf):
    """The nearest known term of misspelled hazards."""
    rows = v.physical(spark, sf).where("hazard <> ''")
    n, hazard = F.col("seq") % 6, F.col("hazard")
    spelled = (
        F.when(n == 1, F.concat(hazard, F.lit("s")))
        .when(n == 2, F.substring(hazard, F.lit(2), F.length(hazard)))
        .when(n == 3, F.concat(F.lit("x"), hazard, F.lit("yy")))
        .when(n == 4, F.reverse(hazard))
        .when(n == 5, F.concat(F.substring(hazard, 1, 1), F.lit("zz"), F.substring(hazard, F.lit(4), F.length(hazard))))
        .otherwise(hazard)
    )
    known = v.vocabulary(spark, sf)
    return vocabulary.with_suggestions(vocabulary.vocabulary_status(rows.select(spelled.alias("hazard")), "hazard", known), known)


@query
def quoted_lines(spark, sf):
    """Rows through CSV files whose values hold line breaks, quotes and commas, read in small blocks."""
    path = joins.staging_path(spark)
    n = F.col("o_orderkey")
    customer = F.col("o_custkey").cast("string")
    note = F.when(n % 3 == 0, F.concat(F.lit('two "lines",\n'), customer)).when(n % 5 == 0, '"').otherwise(customer)
    orders = v.table(spark, sf, "orders").select(n.alias("key"), note.alias("note"), (n % 7).alias("rest"))
    orders.repartition(2, "key").write.csv(path, **writers.CSV_OPTIONS)
    rows = quoted.read_csv(spark, path)
    return rows.select(F.col("key").cast("bigint").alias("key"), "note", F.col("rest").cast("bigint").alias("rest"))


# -- identity over time ----------------------------------------------------------------------


def _sparse_history(spark, sf):
    """Imports of some assets each; two come on one day, and the last one is long after the others."""
    number = v.div("seq", 50) % 5
    days = F.array(*(F.lit(d) for d in ("2026-07-01", "2026-07-11", "2026-07-11", "2026-07-21", "2026-09-19")))
    stamped = v.physical(spark, sf).withColumns(
        {
            "import_id": F.concat(F.lit("import_"), number.cast("string")),
            "imported_at": F.element_at(days, (number + 1).cast("int")),
            "assetId": F.when(number == 2, F.concat("assetId", F.lit("x"))).otherwise(F.col("assetId")),
        }
    )
    asset = F.pmod(F.crc32("assetName"), F.lit(4))
    return stamped.where((asset != number) | (number == 4))


@query
def asset_context_intervals(spark, sf):
    """When which context of an asset held."""
    return validity.context_intervals(_sparse_history(spark, sf), ["seq"]).select(
        "asset_name", "scr_asset_id", "climate_zone", "import_id", "valid_from", "valid_to"
    )


@query
def asset_context_as_of(spark, sf):
    """The context of an asset for every order, as known on the day it is asked for."""
    asked = v.table(spark, sf, "orders").select(
        "o_orderkey",
        v.returned_name(F.col("o_custkey") % 40).alias("asset_name"),
        (F.unix_timestamp(F.lit("2026-06-28").cast("timestamp")) + F.col("o_orderkey") % 130 * validity.DAY).alias("at"),
    )
    intervals = validity.context_intervals(_sparse_history(spark, sf), ["seq"])
    return validity.as_of(asked, intervals, "at").select("o_orderkey", "asset_name", "scr_asset_id", "import_id", "valid_from")


# -- functions -------------------------------------------------------------------------


@query
def infer_asset_type(spark, sf):
    scope = registry.scope_reference(v.registry(spark, sf))
    kind = export.infer_asset_type(
        "primary_fuel", "fuel_types", "technologies", text.first_non_blank("plant_name", "plant_slug")
    )
    return scope.select("plant_uuid", kind.alias("asset_type"))


@query
def compose_address(spark, sf):
    scope = registry.scope_reference(v.registry(spark, sf))
    side = F.when(F.col("eia_plant_id") % 50 == 1, F.lit("Given Street 1"))
    address = text.compose_address(side, "address_raw", "city", "county", "state", "postal_code")
    return scope.select("plant_uuid", address.alias("a")).select("plant_uuid", "a.address", "a.source")


@query
def capex_proxy(spark, sf):
    scope = registry.scope_reference(v.registry(spark, sf))
    value = export.capex_proxy("total_capacity_mw", "latest_capex_per_kw")
    return scope.select("plant_uuid", numbers.decimal_text(value).alias("asset_value"))


@query
def asset_names(spark, sf):
    plants = v.registry(spark, sf).plants
    long, short = (text.asset_name("id", "slug", max_length=n) for n in (120, 40))
    return plants.select(
        "id",
        long.alias("long_name"),
        short.alias("short_name"),
        text.uuid_from_asset_name(long).alias("recovered"),
    )


@query
def normalized_keys(spark, sf):
    p = v.table(spark, sf, "part")
    label = F.concat(F.lit("  "), F.initcap("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")- "))
    return p.select(
        "p_partkey",
        text.normalize_key(label).alias("key"),
        text.slug(label).alias("slug"),
        text.safe_file_name(label).alias("file_name"),
    )


@query
def number_parsing(spark, sf):
    raw = F.concat(
        F.when(F.col("o_orderkey") % 7 == 0, "$").otherwise(""),
        F.floor("o_totalprice").cast("string"),
        F.when(F.col("o_orderkey") % 5 == 0, ".50").otherwise(""),
        F.when(F.col("o_orderkey") % 11 == 0, "d").otherwise(""),
    )
    rows = v.table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return rows.select(
        "o_orderkey",
        numbers.parse_float("raw").alias("as_float"),
        numbers.parse_int("raw").alias("as_int"),
        numbers.decimal_text(numbers.as_decimal("raw")).alias("as_decimal"),
        text.year_value("raw").alias("as_year"),
    )


@query
def rating_functions(spark, sf):
    rows = v.physical(spark, sf)
    three = ("adjustedHazardExposureRating", "hazardExposureRating", "HazardRating")
    return rows.select(
        "seq",
        ratings.rating_score("indicatorRating").alias("score"),
        ratings.worst_rating(*three).alias("worst"),
        ratings.rating_band("indicatorRating").alias("band"),
        ratings.rating_tone("indicatorRating").alias("tone"),
    )


@query
def display_values(spark, sf):
    rows = axes.indicator_rows(v.physical(spark, sf))
    tiny = F.col("value") / 700
    return rows.select(
        "seq",
        display.display_value("value", "percent").alias("percent"),
        display.impact_label(tiny, "percent").alias("percent_label"),
        display.impact_label(tiny, "basis_points", include_raw=True).alias("bps_label"),
        display.impact_label(tiny, "raw").alias("raw_label"),
        display.magnitude_label("value", "unit").alias("magnitude"),
        display.peak_label("value", "horizon").alias("peak"),
    )


@query
def listing_names(spark, sf):
    c = v.table(spark, sf, "customer")
    label = F.concat(
        F.lit(" ASSET NAME : "), F.col("c_name"), F.lit("  Asset type "), F.col("c_mktsegment"), F.lit(" Value 3 ")
    )
    shown = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("  "), F.col("c_name"))).otherwise(label)
    return c.select("c_custkey", text.listing_asset_name(shown).alias("name"))


@query
def url_hosts(spark, sf):
    return v.table(spark, sf, "pages").select("page_id", text.url_host("url").alias("host"))


@query
def points(spark, sf):
    point = text.parse_point("geolocationCoordinates")
    return v.physical(spark, sf).select("seq", point.alias("p")).select(
        "seq", F.col("p.lat").cast("double").alias("lat"), F.col("p.lon").cast("double").alias("lon")
    )


@query
def share_ranges(spark, sf):
    return v.sidecar(spark, sf).select("seq", numbers.share_in_range("flood_barriers").alias("in_range"))


@query
def lookup_join_salted(spark, sf):
    """The lookup join with a third of all rows on one key."""
    line = v.table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_suppkey")).alias("s_suppkey"),
        "l_partkey",
        "l_quantity",
    )
    supplier = v.table(spark, sf, "supplier").select("s_suppkey", "s_name")
    joined = joins.lookup_join(line, supplier, ["s_suppkey"])
    return joined.groupBy("s_suppkey", "s_name").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )
