"""Run-level counts, upload batches and the pre-upload check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.operators.joins import staged

# fixed value: rows one upload file can hold
UPLOAD_CAPACITY = 1001
_ROW_BITS = 33


def count_messages(exported: DataFrame, col: str) -> DataFrame:
    """How often each error or warning occurs, by message."""
    return (
        exported.select(F.explode(col).alias("message"))
        .groupBy("message")
        .agg(F.count("*").alias("n"))
        .orderBy("message")
    )


def total_measures() -> dict[str, Column]:
    """Aggregates that count the rows of a run; selected is always accepted plus rejected."""
    ok = F.size("errors") == 0
    return {
        "selected_rows": F.count(F.lit(1)),
        "accepted_rows": F.count_if(ok),
        "rejected_rows": F.count_if(~ok),
        "rows_with_warnings": F.count_if(F.size("warnings") > 0),
    }


def run_totals(exported: DataFrame) -> DataFrame:
    """One row of counts."""
    return exported.agg(*(c.alias(n) for n, c in total_measures().items()))


def message_counts(exported: DataFrame) -> DataFrame:
    """Errors and warnings of a run with their counts, as ``kind, message, n``; of any number.

    Both are counted in one pass over the rows.
    """

    def listed(col, kind):
        return F.transform(col, lambda message: F.struct(F.lit(kind).alias("kind"), message.alias("message")))

    return (
        exported.select(F.inline(F.concat(listed("errors", "error"), listed("warnings", "warning"))))
        .groupBy("kind", "message")
        .agg(F.count("*").alias("n"))
        .orderBy("kind", "message")
    )


def job_status(totals: DataFrame) -> DataFrame:
    """``completed`` or ``completed with rejects``, with the exit code of the run."""
    bad = F.col("rejected_rows") > 0
    return totals.withColumns(
        {
            "status": F.when(bad, "completed with rejects").otherwise("completed"),
            "exit_code": F.when(bad, 2).otherwise(0),
        }
    )


def preupload_check(exported: DataFrame, include_operating_entity: bool = False) -> DataFrame:
    """One row per rule with its outcome; warnings ask for a review, rejects for a decision."""
    totals = run_totals(exported)
    rules = F.array(
        F.struct(
            F.lit("rejected_rows_is_zero").alias("rule"),
            (F.col("rejected_rows") == 0).alias("passed"),
            F.col("rejected_rows").alias("n"),
        ),
        F.struct(
            F.lit("operating_entity_is_off").alias("rule"),
            F.lit(not include_operating_entity).alias("passed"),
            F.lit(0).cast("bigint").alias("n"),
        ),
        F.struct(
            F.lit("no_warnings_to_review").alias("rule"),
            (F.col("rows_with_warnings") == 0).alias("passed"),
            F.col("rows_with_warnings").alias("n"),
        ),
        F.struct(
            F.lit("has_accepted_rows").alias("rule"),
            (F.col("accepted_rows") > 0).alias("passed"),
            F.col("accepted_rows").alias("n"),
        ),
    )
    return totals.select(F.inline(rules))


def numbered(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """Adds ``row_number``, 1..n in a total order, without a one-task window.

    Rows are range-partitioned and sorted, and each gets its place inside its
    partition. The counts of the partitions, one row each, give the offsets. The
    placed rows are written to the shared folder in between: range bounds are
    sampled, so counts and rows must come from one and the same pass.
    """
    split = df.repartitionByRange(*([partitions] if partitions else []), *order)
    placed = (
        split.sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumns(
            {"_part": F.shiftright("_id", _ROW_BITS), "_place": F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)}
        )
        .drop("_id")
    )
    placed = staged(placed)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row per partition, so this window and the broadcast are bounded
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("row_number", F.col("_offset") + F.col("_place") + 1)
        .drop("_part", "_place", "_offset")
    )


def batch_uploads(accepted: DataFrame, order: Sequence[Column], cap: int = UPLOAD_CAPACITY) -> DataFrame:
    """Adds ``batch_id``: consecutive runs of at most ``cap`` rows in export order.

    The rows are written first, as the bounds of the ranges are sampled by a pass of its own.
    """
    rows = numbered(staged(accepted), order)
    return rows.withColumn("batch_id", F.floor((F.col("row_number") - 1) / cap).cast("int"))
