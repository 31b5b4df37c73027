"""Returned rows to normalized, audited imports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.text import is_blank
from hazardlens.operators import quality
from hazardlens.operators.joins import lookup_join
from hazardlens.sinks.history import History


def normalize_import(rows: DataFrame, manifest: DataFrame, import_id: str, imported_at: str) -> DataFrame:
    """Result rows under their vendor names, with run, plant and membership ids in front."""
    context = manifest.select(
        F.col("scr_asset_name").alias("assetName"),
        *[F.col(f"manifest.{c}").alias(c) for c in ("scr_run_id", "plant_uuid", "portfolio_asset_id")],
    )
    joined = lookup_join(rows, context, ["assetName"], "left")
    return joined.select(
        F.lit(import_id).alias("import_id"),
        F.lit(imported_at).alias("imported_at"),
        "scr_run_id",
        "plant_uuid",
        "portfolio_asset_id",
        *rows.columns,
    )


def check_import(headers: DataFrame | None, rows: DataFrame, manifest: DataFrame, folder: str | None = None) -> None:
    """Raises when anything would make the import wrong, with the number of findings by code.

    With a ``folder`` all findings of this attempt are written there first, one row each.
    """
    found = quality.import_failures(headers, rows, manifest)
    if folder is not None:
        found.write.mode("overwrite").parquet(folder)
        found = found.sparkSession.read.schema(found.schema).parquet(folder)
    # one row per code, of which there are a handful
    counts = found.groupBy("code").agg(F.count("*").alias("n"), F.min("source_file").alias("file")).orderBy("code").collect()
    if counts:
        listed = "; ".join(f"{r['n']} x {r['code']}, first in {r['file']}" for r in counts)
        raise quality.ImportFailure(listed)


def import_manifest(
    normalized: DataFrame, manifest: DataFrame, output_type: str, warnings: DataFrame | None = None
) -> DataFrame:
    """One row per file of an import, with its warning count."""
    stamp = normalized.groupBy("import_id", "source_file").agg(F.max("imported_at").alias("imported_at"))
    summary = quality.import_summary(normalized.drop("scr_run_id", "plant_uuid", "portfolio_asset_id"), manifest)
    rows = summary.join(stamp, ["import_id", "source_file"]).withColumn("output_type", F.lit(output_type))
    if warnings is None:
        return rows.withColumn("warning_count", F.lit(0).cast("bigint"))
    # one row by construction
    return rows.crossJoin(warnings.agg(F.count("*").alias("warning_count")))


def import_measures(rows: DataFrame, metrics: Sequence[str]) -> dict[str, Column]:
    """Aggregates over returned rows that one pass can take: rows, blank names, blank metrics, files that broke off."""
    identified = ~is_blank("assetName") & ~is_blank("scenario") & ~is_blank("timeHorizon")
    corrupt = F.col("_corrupt").isNotNull() if "_corrupt" in rows.columns else F.lit(False)
    return {
        "rows": F.count_if(~corrupt),
        "blank_names": F.count_if(~corrupt & is_blank("assetName")),
        "blank_metrics": F.count_if(~corrupt & identified & ~quality.any_metric(rows, metrics)),
        "unusable_files": F.count_if(corrupt),
    }


def import_returns(
    rows: DataFrame,
    manifest: DataFrame,
    kind: str,
    import_id: str,
    imported_at: str,
    folder: str,
    vocabularies: dict[str, DataFrame],
    metrics: Sequence[str],
    optional: Sequence[str] = (),
    readme: DataFrame | None = None,
    headers: DataFrame | None = None,
) -> dict[str, int | None]:
    """Returned rows of one kind to the history below ``folder``, as one commit.

    ``rows`` are read once, while they are written with the ids of their plants; all that
    follows reads the written rows, and the counts come from that one pass. If headers,
    unusable files or names stop the import, the findings are written, the rows are
    removed and nothing is committed. Else the import manifest and all warnings go beside
    the rows: terms of each vocabulary, blank metrics, absent optional columns and, with
    ``readme``, files whose ReadMe names another asset; then all tables appear together.
    A repeated call adds nothing. Gives the counts (``import_measures``) and the number of
    the commit, None if all of it was there.
    """
    pending = History(rows.sparkSession, folder).begin()
    try:
        done = normalize_import(rows, manifest, import_id, imported_at)
        measures = import_measures(done, metrics)
        written, counts = pending.write(f"{kind}_long", done, import_id, measures, hidden=("_corrupt",))
        check_import(headers, written, manifest, f"{folder}/import_failures/{import_id}")
        written = written.drop("_corrupt")
        plain = written.drop("import_id", "imported_at", "scr_run_id", "plant_uuid", "portfolio_asset_id")
        # blank metrics are listed by file, if there are any
        warnings = quality.import_warnings(plain, vocabularies, metrics if counts["blank_metrics"] else (), optional)
        if readme is not None:
            other = quality.readme_name_mismatches(readme, plain).groupBy("source_file").agg(F.count("*").alias("n"))
            warnings = warnings.unionByName(
                other.select(F.lit("readme_name_differs").alias("code"), F.col("source_file").alias("detail"), "n")
            )
        _, found = pending.write("import_warnings", warnings, import_id, {"n": F.count(F.lit(1))})
        summary = import_manifest(written, manifest, kind).withColumn("warning_count", F.lit(found["n"]).cast("bigint"))
        pending.write("import_manifest", summary, import_id)
        return {**counts, "warnings": found["n"], "version": pending.publish()}
    except BaseException:
        pending.abandon()
        raise


def keep_named(rows: DataFrame, axes: Sequence[str] = ("scenario", "timeHorizon")) -> DataFrame:
    """Rows with identity and axes; blank metrics are results too and stay."""
    kept = ~is_blank("assetName")
    for axis in axes:
        kept = kept & ~is_blank(axis)
    return rows.where(kept)
