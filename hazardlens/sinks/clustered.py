"""Tables laid along a space-filling curve, with an index that tells which files a slice needs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.operators.joins import at_once, lookup_join, staged_and_measured
from hazardlens.operators.runs import numbered

FILE_ROWS = 1_000_000
BITS = 20


def curve_place(codes: Sequence[Column], bits: int) -> Column:
    """Place on the Z-order curve: the bits of all codes in turn, the highest first."""
    width = len(codes)
    parts = [
        F.shiftleft(F.shiftright(code, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * width + width - 1 - i)
        for bit in range(bits)
        for i, code in enumerate(codes)
    ]
    return reduce(Column.bitwiseOR, parts)


def _codes(rows: DataFrame, column: str, bits: int) -> DataFrame:
    """Each value of the column with its rank among all values, stretched over ``bits`` bits.

    Ranks and not values are stretched, so a column of two scenarios splits the table
    in halves as one of a million assets does.
    """
    distinct = rows.select(column).where(F.col(column).isNotNull()).distinct()
    values, seen = staged_and_measured(distinct, n=F.count(F.lit(1)))
    share = (1 << bits) / max(seen["n"], 1)
    rank = F.col("row_number") - 1
    return numbered(values, [F.col(column)]).select(column, F.floor(rank * share).alias(f"_code_{column}"))


def write_clustered(table: DataFrame, path: str, columns: Sequence[str], file_rows: int = FILE_ROWS) -> None:
    """The table along a curve over ``columns``, in files of about ``file_rows`` rows.

    Files are stretches of the curve, so each covers a small range of every column.
    ``<path>/files`` holds the lowest and highest value of each column per file; a
    slice over any of the columns opens only the files it needs (``read_slice``).

    Rows with a null stand with the lowest value. Rows at one place are dealt by their
    number, so a value that many rows share fills as many files as it needs. An empty
    table gives an empty result.
    """
    bits = min(BITS, 63 // len(columns))
    rows, seen = staged_and_measured(table, n=F.count(F.lit(1)))
    placed = rows.withColumn("_number", F.monotonically_increasing_id())
    ranks = at_once(table.sparkSession, [partial(_codes, rows, column, bits) for column in columns])
    for column, of_column in zip(columns, ranks, strict=True):
        placed = lookup_join(placed, of_column, [column], spread="_number")
    codes = [F.coalesce(F.col(f"_code_{c}"), F.lit(0).cast("bigint")) for c in columns]
    placed = placed.withColumn("_place", curve_place(codes, bits))
    parts = max(1, -(-seen["n"] // file_rows))
    laid = placed.repartitionByRange(parts, "_place", "_number").sortWithinPartitions("_place", "_number")
    laid.select(table.columns).write.parquet(f"{path}/data")
    ends = [end for c in columns for end in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"))]
    written = table.sparkSession.read.schema(table.schema).parquet(f"{path}/data")
    index = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"), *ends)
    index.coalesce(1).write.parquet(f"{path}/files")  # a row per file


def _ends(wanted) -> tuple:
    return wanted if isinstance(wanted, tuple) else (wanted, wanted)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__and__, conditions, F.lit(True))


def indexed_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns that the table at ``path`` is laid out by."""
    names = spark.read.parquet(f"{path}/files").columns
    return [name.removeprefix("low_") for name in names if name.startswith("low_")]


def files_of_slice(spark: SparkSession, path: str, wanted: Mapping[str, object]) -> DataFrame:
    """Index rows of the files that may hold rows of the slice."""
    index = spark.read.parquet(f"{path}/files")
    met = []
    for column, value in wanted.items():
        low, high = _ends(value)
        if f"low_{column}" in index.columns:
            met += [F.col(f"high_{column}") >= F.lit(low)] if low is not None else []
            met += [F.col(f"low_{column}") <= F.lit(high)] if high is not None else []
    return index.where(_all(met))


def read_slice(spark: SparkSession, path: str, wanted: Mapping[str, object]) -> DataFrame:
    """Rows of a clustered table whose columns have the wanted values; other files are not opened.

    A value is one value or a pair (lowest, highest), both inclusive, either end None for
    open. A column that the table is not laid out by only filters. Rows that are null in a
    wanted column do not belong to the slice, unless both ends are open.
    """
    # the names of the files that the scan lists anyway
    names = [r["file"] for r in files_of_slice(spark, path, wanted).select("file").collect()]
    if names:
        table = spark.read.parquet(*[f"{path}/data/{name}" for name in names])
    else:
        table = spark.read.parquet(f"{path}/data").limit(0)
    met = []
    for column, value in wanted.items():
        low, high = _ends(value)
        met += [F.col(column) >= F.lit(low)] if low is not None else []
        met += [F.col(column) <= F.lit(high)] if high is not None else []
    return table.where(_all(met))
