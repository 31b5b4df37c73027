"""Checks on returned results: grain, repeats, completeness, mix, import failures and warnings."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.numbers import float_column, is_valid
from hazardlens.functions.text import blank_to_null, is_blank, parse_point, uuid_from_asset_name
from hazardlens.operators.joins import lookup_join
from hazardlens.operators.vocabulary import unused_terms, vocabulary_status

PHYSICAL_GRAIN = ["assetName", "scenario", "timeHorizon", "indicator", "hazard"]
TRANSITION_GRAIN = ["assetName", "scenario", "timeHorizon", "indicator", "subrisk"]


class ImportFailure(ValueError):
    """The returned files cannot be imported."""


# -- headers -----------------------------------------------------------------------


def missing_columns(present: Iterable[str], required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(present))


def require_columns(tables: dict[str, tuple[Iterable[str], Iterable[str]]]) -> dict[str, list[str]]:
    """Checks every table before failing, so one message names all that is missing."""
    missing = {name: missing_columns(present, required) for name, (present, required) in tables.items()}
    bad = {name: cols for name, cols in missing.items() if cols}
    if bad:
        raise ImportFailure("; ".join(f"{name} lacks {', '.join(cols)}" for name, cols in sorted(bad.items())))
    return missing


def detect_kind(columns: Iterable[str]) -> str:
    """``physical`` for a hazard column, ``transition`` for a subrisk column."""
    names = set(columns)
    if "hazard" in names:
        return "physical"
    if "subrisk" in names:
        return "transition"
    raise ImportFailure("neither a hazard nor a subrisk column: the kind of the output is unknown")


def kind_column(header: Column) -> Column:
    """The same rule for many files at once, on an array of header names; null when unknown."""
    return F.when(F.array_contains(header, "hazard"), "physical").when(
        F.array_contains(header, "subrisk"), "transition"
    )


# -- grain and repeats ---------------------------------------------------------------


def check_grain(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def check_repeats(rows: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Groups in which a metric that should repeat differs; nulls are not compared."""
    low_high = [x for c in cols for x in (F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"))]
    differs = [
        F.when(F.col(f"_lo_{c}") != F.col(f"_hi_{c}"), F.lit(c)) for c in cols
    ]
    return (
        rows.groupBy(*keys)
        .agg(*low_high)
        .withColumn("inconsistent", F.concat_ws("|", F.array_compact(F.array(*differs))))
        .where(F.col("inconsistent") != "")
        .select(*keys, "inconsistent")
    )


def check_value_identity(
    rows: DataFrame,
    total: str = "adjustedHazardValueImpact",
    parts: Sequence[str] = ("adjustedHazardDamage", "adjustedHazardDisruptionDamageEquivalent"),
    tolerance: float = 1e-9,
) -> DataFrame:
    """Rows whose total is not the sum of its parts; rows with a null part are not tested."""
    summed = sum((float_column(rows, p) for p in parts[1:]), float_column(rows, parts[0]))
    return rows.withColumn("difference", float_column(rows, total) - summed).where(
        F.abs("difference") > tolerance
    )


def id_drift(history: DataFrame, name: str = "assetName", vendor_id: str = "assetId") -> DataFrame:
    """Assets whose vendor id differs between imports."""
    return (
        history.where(~is_blank(name) & ~is_blank(vendor_id))
        .groupBy(name)
        .agg(F.count_distinct(vendor_id).alias("n_ids"))
        .where(F.col("n_ids") > 1)
    )


def coordinate_grain(generators: DataFrame, key: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Plants with several coordinate pairs, or with coordinates on some generators only."""
    complete = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    pair = F.when(complete, F.struct(lat, lon))
    return (
        generators.groupBy(key)
        .agg(
            F.count("*").alias("n_rows"),
            F.count_distinct(pair).alias("n_pairs"),
            F.count_if(~complete).alias("n_missing"),
        )
        .where((F.col("n_pairs") > 1) | ((F.col("n_missing") > 0) & (F.col("n_missing") < F.col("n_rows"))))
    )


# -- completeness and mix --------------------------------------------------------------


def coverage(rows: DataFrame, families: dict[str, Sequence[str]]) -> DataFrame:
    """Populated share of each metric family, one row per family."""
    present = [c for cols in families.values() for c in cols if c in rows.columns]
    counts = rows.agg(
        F.count("*").alias("_all"), *[F.count(_present(rows, c)).alias(f"_n_{c}") for c in dict.fromkeys(present)]
    )
    shares = []
    for family, cols in families.items():
        filled = sum((F.col(f"_n_{c}") for c in cols if c in present), F.lit(0).cast("bigint"))
        cells = F.col("_all") * F.lit(len(cols))
        shares.append(
            F.struct(
                F.lit(family).alias("family"),
                filled.alias("populated"),
                cells.alias("cells"),
                F.when(cells > 0, filled / cells).alias("share"),
            )
        )
    return counts.select(F.inline(F.array(*shares)))


def _present(rows: DataFrame, col: str) -> Column:
    return blank_to_null(col) if dict(rows.dtypes)[col] == "string" else F.col(col)


def rating_distribution(rows: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per rating, blanks and ``NA`` counted together as ``NA``."""
    return rows.groupBy(*keys, F.coalesce(blank_to_null(col), F.lit("NA")).alias("rating")).agg(
        F.count("*").alias("n")
    )


def row_mix(rows: DataFrame, col: str) -> DataFrame:
    return rows.where(~is_blank(col)).groupBy(col).agg(F.count("*").alias("n"))


def row_matrix(rows: DataFrame, horizons: Sequence[str]) -> DataFrame:
    """Rows per scenario, one column per horizon. The horizons are given, so no extra job."""
    return rows.groupBy("scenario").agg(
        *[F.count_if(F.col("timeHorizon") == h).alias(f"h_{h}") for h in horizons]
    )


def subrisk_matrix(peaks: DataFrame, subrisks: Sequence[str], keys: Sequence[str] = ("scenario",)) -> DataFrame:
    """Largest impact per scenario, one column per subrisk."""
    return peaks.groupBy(*keys).agg(
        *[F.max(F.when(F.col("subrisk") == s, F.col("value"))).alias(s) for s in subrisks]
    )


# -- returned against uploaded ------------------------------------------------------------


def compare_with_manifest(
    assets: DataFrame, manifest: DataFrame, uploaded: DataFrame | None = None, degrees: float = 1e-6
) -> DataFrame:
    """Assets whose returned coordinates, country or class differ from what was sent.

    ``uploaded`` has ``scr_asset_name``, ``country_code`` and ``ticcs_class``; a
    returned sub-class belongs to a class when it starts with the class code.
    """
    right = manifest.select(
        F.col("scr_asset_name").alias("asset_name"),
        F.col("manifest.latitude").try_cast("double").alias("_lat"),
        F.col("manifest.longitude").try_cast("double").alias("_lon"),
    )
    rows = assets.withColumn("_point", parse_point("coordinates")).join(right, "asset_name")

    def moved(field, sent):
        returned = F.col(f"_point.{field}").cast("double")
        return F.coalesce(F.abs(returned - F.col(sent)) > degrees, returned.isNotNull() != F.col(sent).isNotNull())

    checks = {"coordinates_differ": moved("lat", "_lat") | moved("lon", "_lon")}
    if uploaded is not None:
        sent = uploaded.select(
            F.col("scr_asset_name").alias("asset_name"),
            F.col("country_code").alias("_country"),
            F.col("ticcs_class").alias("_class"),
        )
        rows = rows.join(sent, "asset_name", "left")
        checks["country_differs"] = F.coalesce(F.col("country_code") != F.col("_country"), F.lit(False))
        checks["class_differs"] = F.coalesce(~F.startswith(F.col("ticcs_sub_class"), F.col("_class")), F.lit(False))
    flagged = rows.select("asset_name", *[check.alias(name) for name, check in checks.items()])
    any_difference = F.lit(False)
    for name in checks:
        any_difference = any_difference | F.col(name)
    return flagged.where(any_difference)


# -- imports --------------------------------------------------------------------------------


def import_summary(results: DataFrame, manifest: DataFrame) -> DataFrame:
    """Per file: rows, assets, matched and unmatched assets.

    Counted over one row per file and asset, so that a large asset costs one row.
    """
    per_asset = results.groupBy("import_id", "source_file", "assetName").agg(F.count("*").alias("_rows"))
    known = manifest.select(
        F.col("scr_asset_name").alias("assetName"),
        F.lit(True).alias("_known"),
        F.col("manifest.scr_run_id").alias("_run"),
    )
    named = ~is_blank("assetName")
    return (
        lookup_join(per_asset, known, ["assetName"])
        .groupBy("import_id", "source_file")
        .agg(
            F.max("_run").alias("scr_run_id"),
            F.sum("_rows").alias("row_count"),
            F.count_if(named).alias("asset_count"),
            F.count_if(named & F.col("_known").isNotNull()).alias("matched_asset_count"),
            F.count_if(named & F.col("_known").isNull()).alias("unmatched_asset_count"),
        )
    )


def latest_import(history: DataFrame, asset: str = "assetName", import_id: str | None = None) -> DataFrame:
    """The rows of each asset's latest import, or of one import when it is named.

    Imports of the same moment are told apart by their id.
    """
    if import_id is not None:
        return history.where(F.col("import_id") == import_id)
    newest = (
        history.select(asset, "imported_at", "import_id")
        .groupBy(asset)
        .agg(F.max(F.struct("imported_at", "import_id")).alias("_newest"))
    )
    return (
        lookup_join(history, newest, [asset], "inner")
        .where(F.col("import_id") == F.col("_newest.import_id"))
        .drop("_newest")
    )


def import_failures(
    headers: DataFrame | None, results: DataFrame, manifest: DataFrame, name: str = "assetName"
) -> DataFrame:
    """Everything that stops an import, as ``source_file, code, detail``.

    ``headers`` has one row per file: ``source_file``, ``columns`` and ``error``. Rows as
    the workbook reader gives them tell of unusable files themselves, in ``_corrupt``.
    """
    parts = []
    if "_corrupt" in results.columns:
        parts.append(unusable_files(results))
        results = results.where(F.col("_corrupt").isNull())
    if headers is not None:
        parts.extend(_header_failures(headers))
    parts.append(_name_failures(results, manifest, name))
    out = parts[0]
    for other in parts[1:]:
        out = out.unionByName(other)
    return out


def unusable_files(rows: DataFrame) -> DataFrame:
    """Files with a reason in ``_corrupt``, as ``source_file, code, detail``."""
    bad = rows.where(F.col("_corrupt").isNotNull())
    coded = F.regexp_extract("_corrupt", r"\A(missing_columns|wrong_kind|kind_unknown): ", 1)
    code = F.when(coded != "", coded).otherwise("unreadable_file")
    detail = F.regexp_replace("_corrupt", r"\A(missing_columns|wrong_kind|kind_unknown): ", "")
    return bad.select("source_file", code.alias("code"), detail.alias("detail"))


def _header_failures(headers: DataFrame) -> list[DataFrame]:
    unreadable = headers.where(F.col("error").isNotNull()).select(
        "source_file", F.lit("unreadable_file").alias("code"), F.col("error").alias("detail")
    )
    unknown_kind = headers.where(F.col("error").isNull() & kind_column(F.col("columns")).isNull()).select(
        "source_file", F.lit("kind_unknown").alias("code"), F.concat_ws("|", "columns").alias("detail")
    )
    return [unreadable, unknown_kind]


def _name_failures(results: DataFrame, manifest: DataFrame, name: str) -> DataFrame:
    per_asset = results.groupBy("source_file", name).agg(F.count("*").alias("_rows"))
    known = manifest.select(
        F.col("scr_asset_name").alias(name),
        F.col("manifest.plant_uuid").alias("_uuid"),
        F.lit(True).alias("_known"),
    )
    matched = per_asset.join(known, name, "left")
    code = (
        F.when(is_blank(name), "missing_asset_name")
        .when(F.col("_known").isNull(), "asset_not_in_manifest")
        .when(~uuid_from_asset_name(name).eqNullSafe(F.col("_uuid")), "uuid_differs_from_manifest")
    )
    return matched.select("source_file", code.alias("code"), F.coalesce(name, F.lit("")).alias("detail")).where(
        F.col("code").isNotNull()
    )


def any_metric(rows: DataFrame, metrics: Sequence[str]) -> Column:
    """Whether any of the metrics of a row holds a number."""
    filled = F.lit(False)
    for metric in metrics:
        filled = filled | is_valid(float_column(rows, metric))
    return filled


def blank_metric_rows(rows: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ("source_file",)) -> DataFrame:
    """Rows that name an asset and its axes but leave every metric blank, counted per file."""
    identified = ~is_blank("assetName") & ~is_blank("scenario") & ~is_blank("timeHorizon")
    return rows.where(identified & ~any_metric(rows, metrics)).groupBy(*keys).agg(F.count("*").alias("n"))


def import_warnings(
    rows: DataFrame,
    vocabularies: dict[str, DataFrame],
    metrics: Sequence[str],
    optional: Sequence[str] = (),
    history: DataFrame | None = None,
    differences: DataFrame | None = None,
) -> DataFrame:
    """Everything worth a look after an import, as ``code, detail, n``.

    ``vocabularies`` maps a returned column to a table with a column ``term``.
    """
    def part(df, code, detail, n):
        return df.select(F.lit(code).alias("code"), detail.alias("detail"), n.cast("bigint").alias("n"))

    one = F.lit(1)
    parts = []
    for col, vocabulary in vocabularies.items():
        status = vocabulary_status(rows, col, vocabulary)
        missing = status.where(F.col("metadata_mapping_status") == "missing")
        parts.append(part(missing, f"{col}_not_in_metadata", F.col("term"), F.col("row_count")))
        parts.append(part(unused_terms(rows, col, vocabulary), f"{col}_not_returned", F.col("term"), one))
    if metrics:
        parts.append(part(blank_metric_rows(rows, metrics), "metrics_blank", F.col("source_file"), F.col("n")))
    absent = missing_columns(rows.columns, optional)
    if absent:
        listed = rows.sparkSession.createDataFrame([(c,) for c in absent], "column string")
        parts.append(part(listed, "metric_column_missing", F.col("column"), one))
    if history is not None:
        parts.append(part(id_drift(history), "asset_id_changed", F.col("assetName"), F.col("n_ids")))
    if differences is not None:
        moved = differences.where(F.col("coordinates_differ"))
        parts.append(part(moved, "coordinates_differ", F.col("asset_name"), one))
    out = parts[0]
    for other in parts[1:]:
        out = out.unionByName(other)
    return out


def readme_name_mismatches(readme: DataFrame, results: DataFrame) -> DataFrame:
    """Files whose ReadMe names an asset that is not the only one among their rows."""
    listed = results.where(~is_blank("assetName")).select("source_file", "assetName").distinct()
    return listed.join(readme.select("source_file", "readme_asset_name"), "source_file").where(
        F.col("assetName") != F.col("readme_asset_name")
    )
