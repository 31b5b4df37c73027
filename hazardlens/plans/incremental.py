"""Result sets that grow by imports: each import adds states, and the tables are merged from states.

Every column of a result table is an aggregate that can be cut in two: the value with
the largest place, the largest value, the payload of the least key, a sum, the first
three rows of an order. Its state holds what a merge needs, so a row's place goes along
with its value. An import reads its own rows only and commits one row of states per key;
a result table is the merge of all states, in any order, and equals the table built from
all rows at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.functions.numbers import comparable, float_column
from hazardlens.functions.ratings import LETTERS, rating_letter, rating_score, worst_score
from hazardlens.functions.text import blank_to_null, first_non_blank, is_blank
from hazardlens.operators import assets, axes, physical, transition
from hazardlens.operators.axes import KEYS, asset_context, valid_axes
from hazardlens.operators.joins import at_once, staged_together
from hazardlens.plans.reports import Results
from hazardlens.sinks.history import History, Pending

# a row's place over all imports; imports of one moment are told apart by their id
PLACE = ("imported_at", "import_id", "source_file", "seq")
PEAK_KEYS = ["asset_name", "scenario", "subrisk"]
WORST = 3

# how the states of a column are merged, by state table
MERGES = {
    "state_assets": (["asset_name"], {"first": "min"}),
    "state_trends": (KEYS, {**dict.fromkeys(physical.TREND_METRICS, "max"), "score": "max"}),
    "state_hazards": (
        physical.HAZARD_KEYS,
        {**dict.fromkeys(physical.HAZARD_METRICS, "max"), "score": "max", **{f"rating_{x}": "sum" for x in LETTERS}},
    ),
    "state_transition_trends": (KEYS, {"top": "min", "score": "max"}),
    "state_peaks": (PEAK_KEYS, {"first": "min", "best": "min"}),
}
# rows that are kept as they are
EVIDENCE = ("indicators", "subrisks")


def _reduced(rows: DataFrame, table: str, cells: dict[str, Column] | None = None) -> DataFrame:
    """One row of states per key, from rows and the cell of each or from states."""
    keys, how = MERGES[table]
    return rows.groupBy(*keys).agg(*(getattr(F, by)(cells[c] if cells else F.col(c)).alias(c) for c, by in how.items()))


def _place() -> Column:
    return F.struct(*PLACE)


def _worst(rows: DataFrame) -> DataFrame:
    """The first rows of each hazard by rating, value and place; of states as of rows."""
    order = Window.partitionBy(*physical.HAZARD_KEYS).orderBy(F.col("_score").desc(), F.col("_value").desc(), *PLACE)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= WORST)


def physical_states(rows: DataFrame) -> dict[str, DataFrame]:
    """States of the trends, hazards and worst indicators of some rows, and their evidence."""
    base, place = valid_axes(rows), _place()
    rating = rating_score(first_non_blank("adjustedPhysicalExposureRating", "physicalExposureRating"))

    def latest(source):
        value = float_column(base, source)
        return F.when(value.isNotNull(), F.struct(place.alias("place"), value.alias("value")))

    named = base.where(~is_blank("hazard"))
    number = float_column(named, "indicatorValue")
    worst = named.select(
        *physical.HAZARD_KEYS,
        "indicator",
        number.alias("value"),
        blank_to_null("indicatorUnit").alias("unit"),
        blank_to_null("indicatorRating").alias("rating"),
        rating_score("indicatorRating").alias("_score"),
        F.coalesce(comparable(number), F.lit(float("-inf"))).alias("_value"),
        *PLACE,
    )
    return {
        "state_trends": _reduced(
            base, "state_trends", {**{n: latest(s) for n, s in physical.TREND_METRICS.items()}, "score": rating}
        ),
        "state_hazards": _reduced(
            named,
            "state_hazards",
            {
                **{n: comparable(float_column(named, s)) for n, s in physical.HAZARD_METRICS.items()},
                "score": worst_score("adjustedHazardExposureRating", "hazardExposureRating", "HazardRating"),
                **{f"rating_{x}": (F.col("indicatorRating").eqNullSafe(x)).cast("bigint") for x in LETTERS},
            },
        ),
        "state_worst": _worst(worst).drop("rank"),
        "indicators": axes.indicator_rows(rows, PLACE),
    }


def transition_states(rows: DataFrame) -> dict[str, DataFrame]:
    """States of the transition trends and subrisk peaks of some rows, and their evidence."""
    base, place = valid_axes(rows), _place()
    impact = comparable(float_column(base, transition.IMPACT))
    top = F.struct((-impact).alias("rank"), place.alias("place"), impact.alias("impact"), F.col("subrisk"))
    rating = rating_score(first_non_blank("adjustedTransitionExposureRating", "transitionExposureRating"))
    named = base.where(~is_blank("subrisk")).withColumn("value", float_column(base, transition.IMPACT))
    named = named.where(F.col("value").isNotNull())
    peak = F.struct(
        F.col("value"),
        F.col("horizon").alias("year"),
        first_non_blank("adjustedSubriskExposureRating", "subriskExposureRating").alias("rating"),
    ).alias("peak")
    best = F.struct((-F.col("value")).alias("rank"), place.alias("place"), peak)
    return {
        "state_transition_trends": _reduced(
            base, "state_transition_trends", {"top": F.when(impact.isNotNull(), top), "score": rating}
        ),
        "state_peaks": _reduced(
            named,
            "state_peaks",
            {"first": F.struct(place.alias("place"), peak), "best": F.when(~F.isnan("value"), best)},
        ),
        "subrisks": axes.subrisk_rows(rows, PLACE),
    }


def asset_states(physical_rows: DataFrame, transition_rows: DataFrame) -> DataFrame:
    """The first row of every asset; a physical row of any import comes before a transition row."""

    def part(rows, source):
        named = rows.where(~is_blank("assetName"))
        context = [c for c in asset_context(named)][1:]
        first = F.struct(F.lit(source).alias("source"), _place().alias("place"), F.struct(*context).alias("context"))
        return named.select(F.col("assetName").alias("asset_name"), first.alias("first"))

    return _reduced(part(physical_rows, 0).unionByName(part(transition_rows, 1)), "state_assets")


def add_import(
    history: History, import_id: str, imported_at: str, physical_rows: DataFrame, transition_rows: DataFrame
) -> int | None:
    """Commits the states and evidence of one import; reads its rows only.

    Rows are written once to the shared folder, as several states read them. Imports may
    come in any order: what is first or last is told by ``imported_at`` and the id. The
    same import again adds nothing, and with other rows it is refused.
    """
    return add_imports(history, [(import_id, imported_at, physical_rows, transition_rows)])[0]


def add_imports(history: History, imports: Sequence[tuple[str, str, DataFrame, DataFrame]]) -> list[int | None]:
    """``add_import`` for several imports: all are written at the same time, and committed in the order given."""
    pending = [history.begin() for _ in imports]
    try:
        at_once(history.spark, [partial(_write_import, p, *i) for p, i in zip(pending, imports, strict=True)])
        return [p.publish() for p in pending]
    except BaseException:
        for p in pending:
            p.abandon()
        raise


def _write_import(
    pending: Pending, import_id: str, imported_at: str, physical_rows: DataFrame, transition_rows: DataFrame
) -> None:
    stamp = {"imported_at": F.lit(imported_at), "import_id": F.lit(import_id)}
    phys, trans = staged_together(*(rows.withColumns(stamp) for rows in (physical_rows, transition_rows)))
    tables = {**physical_states(phys), **transition_states(trans), "state_assets": asset_states(phys, trans)}
    pending.write_all(tables, import_id)


def results(history: History, manifest: DataFrame | None = None, version: int | None = None) -> Results:
    """The result tables of all imports, or of those up to a commit, merged from their states."""

    def merged(table):
        return _reduced(history.read(table, version), table)

    trends = merged("state_trends").select(
        *KEYS,
        *(F.col(f"{m}.value").alias(m) for m in physical.TREND_METRICS),
        rating_letter("score").alias("adjusted_physical_exposure_rating"),
    )
    rollup = merged("state_hazards").select(
        *physical.HAZARD_KEYS,
        *physical.HAZARD_METRICS,
        rating_letter("score").alias("hazard_rating"),
        F.struct(*(F.col(f"rating_{x}").alias(x) for x in LETTERS)).alias("indicator_rating_counts"),
    )
    shown = F.struct("rank", "indicator", "value", "unit", "rating")
    # at most three rows per hazard reach the list
    worst = _worst(history.read("state_worst", version)).groupBy(*physical.HAZARD_KEYS).agg(
        F.transform(F.array_sort(F.collect_list(shown)), lambda w: w.dropFields("rank")).alias("worst_indicators")
    )
    top = merged("state_transition_trends").select(
        *KEYS,
        F.col("top.impact").alias("max_adjusted_subrisk_revenue_impact"),
        F.col("top.subrisk").alias("top_subrisk"),
        rating_letter("score").alias("transition_rating"),
    )
    # a first value that is NaN is never beaten
    peak = F.when(F.isnan("first.peak.value"), F.col("first.peak")).otherwise(F.col("best.peak"))
    peaks = merged("state_peaks").select(*PEAK_KEYS, peak.alias("_peak"), F.col("first.place").alias("first_seen"))
    found = merged("state_assets").select("asset_name", "first.context.*")
    return Results(
        found if manifest is None else assets.join_back(found, manifest),
        trends,
        rollup.join(worst, physical.HAZARD_KEYS, "left"),
        history.read("indicators", version),
        transition.rank_scenarios(peaks.select(*PEAK_KEYS, "_peak.*", "first_seen")),
        top,
        history.read("subrisks", version),
    )
