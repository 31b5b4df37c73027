"""Vectors compressed to one codebook entry per part, with fixed pivots that prune the search for the nearest entry."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.llm.staging import staged
from hazardlens.llm.topk import integer_vector

SCALE = 1024.0
PARTS, ENTRIES, ROUNDS, PIVOTS = 4, 256, 4, 8
# beyond this size of a component a squared distance might not fit 64 bits
LARGEST = 1 << 28
ROWS = 4096
STEP = 8


@dataclass(frozen=True)
class Compressed:
    """``rows``: id, kept columns, ``codes array<int>``, ``error long``; ``codebooks[part, entry]``: integer vectors."""

    rows: DataFrame
    codebooks: np.ndarray


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """The first entry, then always the one farthest from those chosen (ties to the lower index)."""
    chosen = [0] if len(entries) else []
    far = ((entries - entries[:1]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((entries - entries[chosen[-1]]) ** 2).sum(axis=1))
    return entries[chosen]


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distance of every row of ``x`` to every point."""
    return np.sqrt(((x[:, None, :] - points[None, :, :]).astype(np.float64) ** 2).sum(axis=2))


def nearest(x: np.ndarray, near: np.ndarray, book: np.ndarray, book_near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of each row's nearest entry (ties to the lower index), and how many distances it took.

    ``near`` and ``book_near`` hold the distances of rows and entries to the same fixed
    pivots. A row is no closer to an entry than the largest difference of the two's
    pivot distances. Entries are tried in the order of that bound, and a row is done
    when the bound of the next exceeds the best distance so far; an equal bound goes
    on, as an equal distance may have a lower index.
    """
    n, size = len(x), len(book)
    bound = np.zeros((n, size))
    for place in range(book_near.shape[1]):
        np.maximum(bound, np.abs(near[:, place, None] - book_near[None, :, place]), out=bound)
    # pivot distances are rounded to single precision
    slack = np.abs(near).max(axis=1, initial=0.0) + np.abs(book_near).max(initial=0.0)
    bound = np.square(np.maximum(bound - slack[:, None] * 2.0**-20, 0.0))
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1)
    # sums below 2^53 are exact as doubles, and faster
    top = 2.0 * max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))
    kind = np.float64 if top * top * x.shape[1] < 2**53 else np.int64
    x, book = x.astype(kind), book.astype(kind)
    best, code = np.full(n, np.iinfo(np.int64).max), np.full(n, size)
    live, tried = np.arange(n), 0
    for start in range(0, size, STEP):
        live = live[bound[live, start] <= best[live].astype(np.float64)]
        if not len(live):
            break
        pick = order[live, start : start + STEP]
        gap = x[live, None, :] - book[pick]
        squared = np.einsum("nsw,nsw->ns", gap, gap).astype(np.int64)
        tried += squared.size
        least = squared.min(axis=1)
        index = np.where(squared == least[:, None], pick, size).min(axis=1)
        better = (least < best[live]) | ((least == best[live]) & (index < code[live]))
        best[live[better]], code[live[better]] = least[better], index[better]
    return code, best, tried


def _matrix(column: pa.ListArray, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _slices(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _with_pivots(pivots: np.ndarray):
    """Adds ``_near``, the distance of every part to that part's pivots."""
    parts, _, width = pivots.shape

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(stream):
            x = _matrix(batch.column("_v"), parts * width, np.int64)
            near = [distances(x[:, p * width : (p + 1) * width], pivots[p]) for p in range(parts)]
            flat = pa.array(np.concatenate(near, axis=1).astype(np.float32).tolist(), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, flat], names=[*batch.schema.names, "_near"])

    return run


def _assigner(books: np.ndarray, pivots: np.ndarray):
    """A function from a batch to its integer vectors, codes and squared distances by part."""
    parts, _, width = books.shape
    book_near = [distances(books[p], pivots[p]).astype(np.float32).astype(np.float64) for p in range(parts)]
    count = pivots.shape[1]

    def assign(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = _matrix(batch.column("_v"), parts * width, np.int64)
        near = _matrix(batch.column("_near"), parts * count, np.float64)
        found = [
            nearest(x[:, p * width : (p + 1) * width], near[:, p * count : (p + 1) * count], books[p], book_near[p])
            for p in range(parts)
        ]
        return x, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    return assign


def _sums(books: np.ndarray, pivots: np.ndarray):
    """One row per part and entry that a task has used: how often, and the sum of its parts."""
    parts, size, width = books.shape

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _assigner(books, pivots)
        used, total = np.zeros(parts * size, np.int64), np.zeros((parts * size, width), np.int64)
        for batch in _slices(stream):
            x, codes, _ = assign(batch)
            for p in range(parts):
                slot = codes[:, p] + p * size
                used += np.bincount(slot, minlength=parts * size)
                np.add.at(total, slot, x[:, p * width : (p + 1) * width])
        slot = np.flatnonzero(used)
        columns = [pa.array(slot), pa.array(used[slot]), *(pa.array(total[slot, i]) for i in range(width))]
        yield pa.RecordBatch.from_arrays(columns, names=["slot", "used", *(f"s{i}" for i in range(width))])

    return run


def _coded(books: np.ndarray, pivots: np.ndarray, keep: Sequence[str]):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _assigner(books, pivots)
        for batch in _slices(stream):
            _, codes, squared = assign(batch)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(codes.tolist(), pa.list_(pa.int32())), pa.array(squared.sum(axis=1))],
                names=[*keep, "codes", "error"],
            )

    return run


def compress(
    df: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    keep: Sequence[str] = (),
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> Compressed:
    """Every vector as ``parts`` codebook indexes, and the codebooks.

    Components become ``floor(1024 * x)``; vectors are cut into equal consecutive parts,
    each with a codebook of its own that starts as that part of the ``entries`` vectors
    of smallest id. Each of ``rounds`` rounds assigns every part to its nearest entry
    (``nearest``) and moves every entry to the floor of the mean of its parts; an unused
    one stays. Then parts are assigned once more; ``error`` is the sum of the squared
    distances over the parts. All arithmetic on vectors is in whole numbers.

    The pivots are ``pivots`` entries of each first codebook, far from each other. The
    distances of all parts to them are computed once and written beside the vectors;
    each round computes only those of the moved entries. A round is one pass over that
    table without a shuffle of vectors: a task sends one row per entry that it used, and
    the codebooks, ``parts * entries`` rows whatever the input, go over the driver.

    Vectors that are null or hold a null or non-finite component, whose length is no
    multiple of ``parts`` or differs from that of the smallest id take no part. Rows
    without an id come last, repeated ids and rows all count, the smaller vector first.
    Fewer vectors than ``entries`` make shorter codebooks; an empty table gives no rows
    and empty codebooks. Columns other than ``keep`` are not read. A component of
    2 ** 18 or more fails the job, as its squares would not fit 64 bits.
    """
    v = integer_vector(F.col(vector), SCALE)
    names = [f"_keep{i}" for i in range(len(keep))]
    rows = df.select(F.col(id).alias("_id"), *(F.col(c).alias(n) for c, n in zip(keep, names)), v.alias("_v"))
    rows = rows.where(f"_v is not null and size(_v) % {parts} = 0")
    in_order = F.col("_id").asc_nulls_last(), F.col("_v")
    first = rows.orderBy(*in_order).limit(1).select(F.size("_v")).first()
    length = first[0] if first else 0
    width = length // parts
    too_large = F.raise_error(F.lit(f"{vector} holds a component of {LARGEST / SCALE:.0f} or more"))
    checked = F.when(F.exists("_v", lambda c: F.abs(c) >= LARGEST), too_large).otherwise(F.col("_v"))
    rows = rows.where(F.size("_v") == length).withColumn("_v", checked.cast("array<int>"))
    start = [r["_v"] for r in rows.select("_id", "_v").orderBy(*in_order).limit(entries).collect()]
    whole = np.array(start, np.int64).reshape(len(start), parts, width)
    books = np.ascontiguousarray(whole.transpose(1, 0, 2))
    fixed = np.stack([choose_pivots(book, pivots) for book in books])

    schema = rows.schema.simpleString().removeprefix("struct<").removesuffix(">")
    table = staged(rows.mapInArrow(_with_pivots(fixed), f"{schema},_near:array<float>"))
    for _ in range(rounds if start else 0):
        parted = f"slot long, used long, {', '.join(f's{i} long' for i in range(width))}".rstrip(", ")
        sums = table.select("_v", "_near").mapInArrow(_sums(books, fixed), parted).groupBy("slot")
        for moved in sums.agg(F.sum("used").alias("used"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(width))).collect():
            part, entry = divmod(moved["slot"], len(start))
            books[part, entry] = [moved[f"s{i}"] // moved["used"] for i in range(width)]
    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"{n} {kinds[n]}" for n in ["_id", *names]), "codes array<int>", "error long"])
    coded = table.mapInArrow(_coded(books.copy(), fixed, ["_id", *names]), schema)
    return Compressed(coded.toDF(id, *keep, "codes", "error"), books)


def restore(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """The rows of ``coded`` with ``vector array<bigint>``, the integer vector that ``codes`` stands for; null stays null."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            vectors = [
                None if c is None else np.concatenate([books[p, e] for p, e in enumerate(c)]).tolist()
                for c in batch.column("codes").to_pylist()
            ]
            column = pa.array(vectors, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "vector"])

    schema = coded.schema.simpleString().removeprefix("struct<").removesuffix(">")
    return coded.mapInArrow(run, f"{schema},vector:array<bigint>")
