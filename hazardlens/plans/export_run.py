"""Registry to upload: one plan, computed once because four files are written from it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hazardlens.operators import export, runs, sidecar
from hazardlens.operators.export import ExportOptions
from hazardlens.operators.joins import staged_and_measured
from hazardlens.sinks import writers


def run_export(
    scope: DataFrame,
    asset_types: DataFrame,
    country_codes: DataFrame,
    opts: ExportOptions,
    folder: str,
    sidecar_rows: DataFrame | None = None,
    batched: bool = False,
    **scope_names: str | None,
) -> dict:
    """Writes upload, manifest, rejects and summary below ``folder/<run id>``.

    The counts of the summary come from the pass that computes the rows.

    ``scope`` comes from one of the registry scopes. The result is the summary with
    the status of the run; rejects make it "completed with rejects", exit code 2.
    """
    index = (
        export.empty_sidecar_index(scope.sparkSession)
        if sidecar_rows is None
        else sidecar.index_sidecar(sidecar_rows, [c for c in ("source_file", "seq") if c in sidecar_rows.columns])
    )
    exported = export.export_rows(scope, index, asset_types, country_codes, opts)
    # the shared folder, not an executor's disk: a lost executor costs no second export
    exported, totals = staged_and_measured(exported, **runs.total_measures())
    target = f"{folder}/{opts.run_id}"
    write = writers.write_upload_batches if batched else writers.write_upload
    write(exported, f"{target}/upload")
    writers.write_manifest(exported, f"{target}/manifest", opts)
    writers.write_rejects(exported, f"{target}/rejects", opts)
    summary = writers.write_run_summary(exported, f"{target}/run_summary", opts, totals, **scope_names)
    rejected = summary["rejected_rows"] > 0
    return {
        **summary,
        "status": "completed with rejects" if rejected else "completed",
        "exit_code": 2 if rejected else 0,
    }
