"""Returned rows to result tables: the whole build as one set of lazy tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.ordering import ROW_ORDER, file_order
from hazardlens.operators import assets, physical, quality, response, transition
from hazardlens.operators.joins import staged_and_measured, staged_together
from hazardlens.plans.reports import Results
from hazardlens.schemas import PHYSICAL_REQUIRED, TRANSITION_REQUIRED


def build_results(
    physical_rows: DataFrame,
    transition_rows: DataFrame,
    manifest: DataFrame | None = None,
    order: Sequence[str] = ROW_ORDER,
    stage: bool = True,
) -> Results:
    """Trends, hazards, rankings and evidence of one or many return files.

    Both tables are checked for their required columns before anything is built. Seven
    tables read them, so each is written once to the shared folder first and workbooks
    are decoded once; ``stage=False`` leaves that out where the rows are stored already.
    Over several files pass ``order=("source_file", "seq")``. With a manifest, as
    read by ``read_manifest``, every asset carries its context.
    """
    quality.require_columns(
        {
            "physical": (physical_rows.columns, PHYSICAL_REQUIRED),
            "transition": (transition_rows.columns, TRANSITION_REQUIRED),
        }
    )
    if stage:
        physical_rows, transition_rows = staged_together(physical_rows, transition_rows)
    found = assets.assets(physical_rows, transition_rows, order)
    if manifest is not None:
        found = assets.join_back(found, manifest)
    phys = physical.build_physical(physical_rows, order)
    trans = transition.build_transition(transition_rows, order)
    return Results(
        found,
        phys["trends"],
        phys["hazards"],
        phys["indicators"],
        trans["scenario_rankings"],
        trans["trends"],
        trans["subrisks"],
    )


def build_meta(
    physical_rows: DataFrame,
    transition_rows: DataFrame,
    generated_at: str,
    counts: dict[str, int] | None = None,
    **sources: str,
) -> DataFrame:
    """One row about the build: all returned rows, before any is dropped, missing columns, sources.

    ``counts`` are those of ``stage_returns``; without them both tables are counted here.
    """

    def missing(rows, required):
        return F.array(*[F.lit(c) for c in quality.missing_columns(rows.columns, required)]).cast("array<string>")

    known = {
        "generated_at": F.lit(generated_at),
        "physical_missing": missing(physical_rows, PHYSICAL_REQUIRED),
        "transition_missing": missing(transition_rows, TRANSITION_REQUIRED),
        **{name: F.lit(value) for name, value in sources.items()},
    }
    if counts is None:
        # one row on each side
        rows = physical_rows.agg(F.count("*").alias("physical_rows")).crossJoin(
            transition_rows.agg(F.count("*").alias("transition_rows"))
        )
    else:
        pair = (counts["physical_rows"], counts["transition_rows"])
        rows = physical_rows.sparkSession.createDataFrame([pair], "physical_rows long, transition_rows long")
    return rows.withColumns(known)


def stage_returns(physical_rows: DataFrame, transition_rows: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Both tables written once, and their rows counted on the way; for ``build_results(..., stage=False)``."""
    phys, counts = staged_and_measured(physical_rows, physical_rows=F.count(F.lit(1)))
    trans, more = staged_and_measured(transition_rows, transition_rows=F.count(F.lit(1)))
    return phys, trans, {**counts, **more}


def report_order(table: DataFrame, name: str) -> list[Column]:
    """The order a reader expects of each result table, as sort keys; it is total."""
    blank = F.lit("")
    keys = [F.col(c) for c in ("asset_name", "scenario", "horizon")]
    place = [F.col(c) for c in file_order(table)]

    def text(c):
        return F.coalesce(F.col(c), blank)

    orders = {
        "assets": lambda: keys[:1],
        "physical_trends": lambda: keys,
        "physical_hazards": lambda: [*keys, F.col("hazard")],
        "physical_indicators": lambda: [*keys, text("hazard"), text("indicator"), *place],
        "transition_trends": lambda: keys,
        "transition_subrisks": lambda: [*keys, text("subrisk"), text("indicator"), *place],
        "transition_scenario_rankings": lambda: [keys[0], F.col("peak_impact").desc(), keys[1]],
        "response_points": lambda: [*(F.col(c) for c in response.SERIES), F.col("x"), keys[2], *place],
    }
    return orders[name]()


def in_report_order(table: DataFrame, name: str) -> DataFrame:
    """The table sorted as its readers expect; only worth its sort on the way out."""
    return table.orderBy(*report_order(table, name))
