"""Upload, manifest, rejects, run summary, result sets, imports and history on disk."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.operators import export, registry, runs
from hazardlens.operators.export import ExportOptions
from hazardlens.operators.joins import at_once, staged_and_measured
from hazardlens.plans.reports import Results
from hazardlens.schemas import UPLOAD_LAYOUT
from hazardlens.sinks import clustered
from hazardlens.sinks.history import History

# blanks stay blank, outer spaces stay, and inner quotes are doubled as spreadsheet programs do
CSV_OPTIONS = {
    "header": True,
    "emptyValue": "",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _upload_columns() -> list[Column]:
    """The vendor's 58 columns under their exact headers, and never any other."""
    columns = export.upload_columns()
    return [columns[key].alias(header) for key, header in UPLOAD_LAYOUT]


def write_upload(exported: DataFrame, path: str) -> None:
    """Accepted rows as the vendor's CSV. The private manifest columns stay out of it."""
    export.accepted(exported).select(*_upload_columns()).write.csv(path, **CSV_OPTIONS)


def write_upload_batches(exported: DataFrame, path: str, cap: int = runs.UPLOAD_CAPACITY) -> None:
    """Accepted rows in files of at most ``cap`` rows, one folder ``batch_id=n`` each."""
    accepted = export.accepted(exported)
    rows = runs.batch_uploads(accepted, registry.export_order(), cap)
    laid_out = rows.select(*_upload_columns(), "batch_id", "row_number")
    (
        laid_out.repartition("batch_id")
        .sortWithinPartitions("batch_id", "row_number")
        .drop("row_number")
        .write.partitionBy("batch_id")
        .csv(path, **CSV_OPTIONS)
    )


def write_manifest(exported: DataFrame, path: str, opts: ExportOptions) -> None:
    """Every selected row. Keep it beside the returned files; it is never uploaded."""
    export.manifest_rows(exported, opts).write.csv(path, **CSV_OPTIONS)


def write_rejects(exported: DataFrame, path: str, opts: ExportOptions) -> None:
    export.manifest_rows(export.rejected(exported), opts).write.csv(path, **CSV_OPTIONS)


def write_run_summary(
    exported: DataFrame, path: str, opts: ExportOptions, totals: dict[str, int] | None = None, **scope: str | None
) -> dict:
    """Options and counts of a run as one JSON object, message counts as a table beside it.

    ``totals`` come from the pass that wrote the rows; without them the messages of the
    rows are written here and counted on the way, so that the rows are computed once.

    Messages quote free text, so their number has no bound; they go to ``<path>_messages``.
    """
    spark = exported.sparkSession
    if totals is None:
        exported, totals = staged_and_measured(exported.select("errors", "warnings"), **runs.total_measures())
    options = asdict(opts)
    summary = {"scr_run_id": options.pop("run_id"), **options, **scope, **totals}
    spark.createDataFrame([(json.dumps(summary),)], "value string").coalesce(1).write.text(path)
    runs.message_counts(exported).write.json(f"{path}_messages")
    return summary


RESULT_TABLES = {
    "assets": "assets",
    "trends": "physical_trends",
    "hazards": "physical_hazards",
    "indicators": "physical_indicators",
    "rankings": "transition_scenario_rankings",
    "transition_trends": "transition_trends",
    "subrisks": "transition_subrisks",
}


def write_results(results: Results, folder: str, meta: DataFrame | None = None, fmt: str = "parquet") -> None:
    """One table per section, partitioned by scenario so that a view reads one scenario.

    Rows are dealt by scenario and range of asset, so that a scenario has few files, each
    sorted by asset, and a view of one asset skips most row groups.
    """

    def write(field, name):
        table = getattr(results, field)
        keys = [c for c in ("scenario", "asset_name") if c in table.columns]
        writer = table.repartitionByRange(*keys).sortWithinPartitions(*keys).write.format(fmt)
        if "scenario" in table.columns:
            writer = writer.partitionBy("scenario")
        writer.save(f"{folder}/{name}")

    # no table waits for another
    at_once(results.trends.sparkSession, [partial(write, *item) for item in RESULT_TABLES.items()])
    if meta is not None:
        meta.write.format(fmt).save(f"{folder}/meta")


def write_clustered_results(results: Results, folder: str, file_rows: int = clustered.FILE_ROWS) -> None:
    """One table per section along a curve over scenario, horizon and asset, with an index of its files.

    For readers that slice by any of the three (``read_results_slice``); ``write_results``
    serves those that always name the scenario.
    """

    def write(field, name):
        table = getattr(results, field)
        keys = [c for c in ("scenario", "horizon", "asset_name") if c in table.columns]
        clustered.write_clustered(table, f"{folder}/{name}", keys, file_rows)

    at_once(results.trends.sparkSession, [partial(write, *item) for item in RESULT_TABLES.items()])


def write_ordered(table: DataFrame, path: str, order: Sequence[Column]) -> None:
    """The table in a total order that its files keep: each row with its ``position`` from 1.

    Rows are sorted by ranges and numbered without a one-task window (``runs.numbered``);
    each file holds a stretch of positions in order, so a page is found by the lowest and
    highest position that Parquet keeps per row group (``read_page``).
    """
    rows = runs.numbered(table, order).withColumnRenamed("row_number", "position")
    rows.repartitionByRange("position").sortWithinPartitions("position").write.parquet(path)


def write_import(
    folder: str,
    import_id: str,
    physical: DataFrame | None = None,
    transition: DataFrame | None = None,
    summary: DataFrame | None = None,
    warnings: DataFrame | None = None,
) -> int | None:
    """Normalized long results, import manifest and warnings in one commit of the history.

    Vendor column names stay. An import that is there with the same rows adds nothing, as
    when a run is repeated; one with other rows is refused.
    """
    tables = {
        "physical_long": physical,
        "transition_long": transition,
        "import_manifest": summary,
        "import_warnings": warnings,
    }
    given = {name: table for name, table in tables.items() if table is not None}
    spark = next(iter(given.values())).sparkSession
    return History(spark, folder).append(import_id, **given)
