"""CSV files whose values hold line breaks, read by many tasks.

Where a record starts depends on whether the line begins inside a quoted value, and that
on all that comes before it in the file. So each block of lines is read once for both
cases: for either state at its start it tells the state before and after every line.
Running the blocks of a file one after the other, two small numbers each, then tells
the true state at each block's start, and with it which reading is right. Lines that are
whole records stay where they were read; only the lines of broken records meet.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPTIONS = {"quote": '"', "escape": '"'}
_BLOCK_KEYS = ["source_file", "_block"]


def after_line(line: str, inside: bool) -> bool:
    """Whether a quoted value is open behind the line, given whether one is before it.

    A quote opens a value only where a field starts; two quotes in a value are one of its
    characters; what stands behind a closing quote belongs to the field up to the comma.
    """
    at = 0
    while True:
        if inside:
            end = line.find('"', at)
            while end >= 0 and line.startswith('"', end + 1):
                end = line.find('"', end + 2)
            if end < 0:
                return True
            at, inside = end + 1, False
        elif line.startswith('"', at):
            at, inside = at + 1, True
            continue
        comma = line.find(",", at)
        if comma < 0:
            return False
        at = comma + 1


class _Block:
    """Runs through a block's lines for both states at its start."""

    def __init__(self) -> None:
        self.lines, self.state, self.last = 0, [False, True], [-1, -1]

    def read(self, values: pa.StringArray) -> dict[str, np.ndarray]:
        n = len(values)
        quoted = pc.fill_null(pc.match_substring(values, '"'), False).to_numpy(zero_copy_only=False)
        before = np.empty((2, n), bool)
        after = np.empty((2, n), bool)
        begin = 0
        # lines without a quote leave the state as it is
        for place in [*np.flatnonzero(quoted), n]:
            for s in (0, 1):
                before[s, begin : place + 1] = self.state[s]
                after[s, begin:place] = self.state[s]
            if place < n:
                line = values[int(place)].as_py()
                self.state = [after_line(line, s) for s in self.state]
                after[:, place] = self.state
            begin = place + 1
        number = np.arange(self.lines, self.lines + n)
        out = {"_line": number}
        for s in (0, 1):
            start = np.maximum.accumulate(np.where(before[s], -1, number)) if n else number
            start = np.maximum(start, self.last[s])
            if n:
                self.last[s] = int(start[-1])
            out |= {f"_start{s}": start, f"_whole{s}": ~before[s] & ~after[s], f"_after{s}": after[s]}
        self.lines += n
        return out


def _states(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, block = None, _Block()
    for batch in stream:
        files = batch.column("source_file").to_pylist()
        blocks = batch.column("_block").to_pylist()
        edges = [i for i in range(1, len(files)) if (files[i], blocks[i]) != (files[i - 1], blocks[i - 1])]
        for a, b in zip([0, *edges], [*edges, len(files)]):
            if a == b:
                continue
            if (files[a], blocks[a]) != current:
                current, block = (files[a], blocks[a]), _Block()
            part = batch.slice(a, b - a)
            found = block.read(part.column("value"))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(x) for x in found.values())], names=[*part.schema.names, *found]
            )


def _in_order(blocks: pd.DataFrame) -> pd.DataFrame:
    """The state at the start of each block of a file, and the record that is open there."""
    state, open_block, open_line, rows = False, -1, -1, []
    for row in blocks.sort_values("_block").itertuples(index=False):
        name, number, ends, lasts = row[0], row[1], row[2:4], row[4:6]
        rows.append((name, number, state, open_block, open_line))
        if lasts[state] >= 0:
            open_block, open_line = number, lasts[state]
        state = bool(ends[state])
    out = pd.DataFrame(rows, columns=["source_file", "_block", "_state", "_open_block", "_open_line"])
    return out.assign(_torn=state)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``source_file, seq, record``: the records of CSV files as text, and their place in the file.

    ``seq`` rises along a file. Blank lines between records are left out. A file that
    ends inside a quoted value stops the job, with its name. Line breaks are ``\\n``, with
    or without ``\\r``.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_block"), "value"
    )
    kinds = ", ".join(f"_start{s} long, _whole{s} boolean, _after{s} boolean" for s in (0, 1))
    states = lines.mapInArrow(_states, f"source_file string, _block long, value string, _line long, {kinds}")
    last = [F.max_by(f"_after{s}", "_line").alias(f"_end{s}") for s in (0, 1)]
    starts = [F.max(f"_start{s}").alias(f"_last{s}") for s in (0, 1)]
    blocks = states.groupBy(*_BLOCK_KEYS).agg(*last, *starts)
    ordered = blocks.groupBy("source_file").applyInPandas(
        _in_order, "source_file string, _block long, _state boolean, _open_block long, _open_line long, _torn boolean"
    )
    # one row per block of files, 128 MB each by default, or per smaller file
    known = states.join(F.broadcast(ordered), _BLOCK_KEYS)
    torn = F.raise_error(F.concat(F.lit("a quoted value is not closed in "), F.col("source_file"))).cast("boolean")
    known = known.where(F.when(F.col("_torn"), torn).otherwise(True))

    def under(name):
        return F.when(F.col("_state"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    # a line of a block starts at its place or later, so places rise from block to block
    here = F.col("_block") + F.col("_line")
    start = under("_start")
    begun = F.when(start >= 0, F.col("_block") + start).otherwise(F.col("_open_block") + F.col("_open_line"))
    whole = known.where(under("_whole")).select("source_file", here.alias("seq"), F.col("value").alias("record"))
    parts = known.where(~under("_whole")).select("source_file", begun.alias("seq"), F.struct(here.alias("at"), "value").alias("part"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["value"]), "\n")
    # a record's lines; no other lines meet
    broken = parts.groupBy("source_file", "seq").agg(joined.alias("record"))
    found = whole.unionByName(broken)
    plain = F.regexp_replace("record", "\\r\\z", "")
    first = F.when(F.col("seq") == 0, F.regexp_replace(plain, "\\A\\ufeff", "")).otherwise(plain)
    return found.withColumn("record", first).where(F.trim("record") != "")


def _parsed(width: int) -> Column:
    return F.from_csv("record", F.lit(", ".join(f"c{i} string" for i in range(width)) or "c0 string"), OPTIONS)


def cells(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """``source_file, seq`` and the values of each record under ``names``, as text."""
    parsed = rows.withColumn("_cells", _parsed(len(names)))
    return parsed.select("source_file", "seq", *(F.col(f"_cells.c{i}").alias(n) for i, n in enumerate(names)))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files that share one header, as text columns beside ``source_file`` and ``seq``.

    The header has no line breaks. A file with another header is an error and not a
    silent shift of columns.
    """
    header = spark.read.csv(path, header=False, **OPTIONS).limit(1).first()
    names = ["" if name is None else name for name in header or ()]
    rows = records(spark, path)
    heads = rows.groupBy("source_file").agg(F.min("seq").alias("_head"))
    # one row per file
    placed = rows.join(F.broadcast(heads), "source_file")
    # as one value: a condition per column would each be carried through the plan
    spelled = F.concat_ws("\x1f", *(F.coalesce(f"_cells.c{i}", F.lit("")) for i in range(len(names))))
    other = F.raise_error(F.concat(F.lit("another header in "), F.col("source_file"))).cast("boolean")
    same = F.when(spelled == "\x1f".join(names), False).otherwise(other)
    found = placed.withColumn("_cells", _parsed(len(names)))
    body = found.where(F.when(F.col("seq") > F.col("_head"), True).otherwise(same))
    return body.select("source_file", "seq", *(F.col(f"_cells.c{i}").alias(n) for i, n in enumerate(names)))
