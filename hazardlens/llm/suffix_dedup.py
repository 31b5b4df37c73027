"""Removal of byte strings that occurred before, settled by suffix arrays over aligned contexts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.llm import batches
from hazardlens.llm.staging import staged
from hazardlens.llm.suffix_order import suffix_array

LENGTH = 100
ANCHOR = 24
BLOCK = 1 << 20
CHUNK = 1 << 15
ARRAY_BYTES = 1 << 12
SPANS = 1 << 12
LARGE_GROUP = 2048

_rng = np.random.Generator(np.random.PCG64(31))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15


def _power(k: int) -> np.uint64:
    return np.uint64(pow(_FACTOR, k, 1 << 64))


def anchor_values(data: np.ndarray, anchor: int) -> np.ndarray:
    """A hash of the ``anchor`` bytes from every place on, by joining halves."""
    whole, width, done = None, 1, 0
    part = _BYTE[data]
    rest = anchor
    while True:
        if rest & 1:
            if whole is None:
                whole = part
            else:
                n = len(data) - done - width + 1
                whole = whole[:n] * _power(width) + part[done : done + n]
            done += width
        rest >>= 1
        if not rest:
            return batches.mix(whole)
        n = len(data) - 2 * width + 1
        part = part[:n] * _power(width) + part[width : width + n]
        width *= 2


def first_least(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values the place of its smallest, the first of equals.

    The lowest bits of the values make room for the places, as many for all calls of one
    width, so at most ``CHUNK + width`` values are taken. Values equal in all other bits
    count as equal.
    """
    low = np.uint64((1 << (CHUNK + width).bit_length()) - 1)
    best = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while span < width:
        step = min(span, width - span)
        best = np.minimum(best[step:], best[: len(best) - step])
        span += step
    return (best & low).astype(np.int64)


def contexts(data: np.ndarray, first: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of ``length`` bytes that have the same anchor, none across texts.

    ``first`` holds where each text begins, with the end of the last. The anchor of a
    window is the smallest of its ``anchor``-byte hashes, the first of equals, so equal windows
    have equal anchors at equal places. Gives for each run its text, the place of its
    first window, the number of windows, the anchor's place and value.
    """
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    n = len(data) - length + 1
    values, place = np.empty(len(data) - anchor + 1, np.uint64), np.empty(n, np.int64)
    for at in range(0, n, CHUNK):
        # a chunk's arrays stay in the processor's cache
        own = anchor_values(data[at : at + CHUNK + length - 1], anchor)
        least = first_least(own, length - anchor + 1)
        values[at : at + len(own)] = own
        place[at : at + len(least)] = least + at
    new = np.empty(n, bool)
    new[0], new[1:] = True, place[1:] != place[:-1]
    new[first[first < n]] = True
    start = np.flatnonzero(new)
    text = np.searchsorted(first, start, side="right") - 1
    end = np.minimum(np.append(start[1:], n), first[text + 1] - length + 1)
    inside = end > start
    text, start, end = text[inside], start[inside], end[inside]
    return text, start, end - start, place[start], values[place[start]]


def _anchored(length: int, anchor: int):
    """Contexts of every text; those that an earlier text of the same slice holds are settled here."""

    def blocks(keys: list[int], texts: list[bytes]):
        whole, sizes, own, offsets = [], [], [], []
        for key, text in zip(keys, texts):
            # a long text goes in blocks that share length - 1 bytes, so that no window is lost
            for at in range(0, max(1, len(text) - length + 1), BLOCK):
                part = text[at : at + BLOCK + length - 1]
                whole.append(part)
                sizes.append(len(part))
                own.append(key)
                offsets.append(at)
                if sum(sizes) >= BLOCK:
                    yield whole, sizes, own, offsets
                    whole, sizes, own, offsets = [], [], [], []
        if whole:
            yield whole, sizes, own, offsets

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in batches.pieces(stream, "text"):
            keys, texts = piece.column("doc").to_pylist(), batches.encoded(piece.column("text"))
            for whole, sizes, own, offsets in blocks(keys, texts):
                joined = b"".join(whole)
                first = np.concatenate([[0], np.cumsum(sizes)])
                text, start, windows, place, value = contexts(np.frombuffer(joined, np.uint8), first, length, anchor)
                digest, ends = xxhash.xxh3_64_digest, start + windows + (length - 1)
                whole_contexts = b"".join([digest(joined[a:b]) for a, b in zip(start.tolist(), ends.tolist())])
                context = np.frombuffer(whole_contexts, ">u8").astype(np.uint64)
                doc = np.array(own, np.int64)[text]
                local = start - first[text] + np.array(offsets, np.int64)[text]
                order = np.lexsort((local, doc, context, value))
                again = np.zeros(len(order), bool)
                v, c = value[order], context[order]
                again[order[1:]] = (v[1:] == v[:-1]) & (c[1:] == c[:-1])
                # neighbouring settled contexts of a text become one span
                d, a, b = doc[again], local[again], (local + windows)[again]
                lead = np.concatenate([[True], (d[1:] != d[:-1]) | (a[1:] > b[:-1] + length - 1)]) if len(d) else np.zeros(0, bool)
                last = np.concatenate([lead[1:], [True]]) if len(d) else lead
                spans = int(lead.sum())
                new = ~again
                done = np.concatenate([np.zeros(int(new.sum()), bool), np.ones(spans, bool)])
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": np.concatenate([value[new].view(np.int64), batches.mix(d[lead].view(np.uint64)).view(np.int64)]),
                        "context": pa.array(np.concatenate([context[new].view(np.int64), np.zeros(spans, np.int64)]), mask=done),
                        "doc": np.concatenate([doc[new], d[lead]]),
                        "start": np.concatenate([local[new], a[lead]]).astype(np.int32),
                        "windows": np.concatenate([windows[new], b[last] - a[lead]]).astype(np.int32),
                        "lead": np.concatenate([(place - start)[new], np.zeros(spans, np.int64)]).astype(np.int32),
                    }
                )

    return run


ANCHORED = "anchor long, context long, doc long, start int, windows int, lead int"


def _agreement(parts: list[bytes]) -> list[int]:
    """For each string the most bytes it has in common with the beginning of another one."""
    most = [0] * len(parts)
    order = sorted(range(len(parts)), key=parts.__getitem__)
    for i, j in zip(order, order[1:]):
        n = min(len(parts[i]), len(parts[j]))
        differ = int.from_bytes(parts[i][:n], "big") ^ int.from_bytes(parts[j][:n], "big")
        same = n - (differ.bit_length() + 7) // 8
        most[i], most[j] = max(most[i], same), max(most[j], same)
    return most


class _Windows:
    """Contexts of whole anchor groups, gathered until they are worth a suffix array."""

    def __init__(self, length: int):
        self.length, self.parts, self.docs, self.starts, self.copies, self.bytes = length, [], [], [], [], 0

    def add(self, rows: list[tuple[int, int, int, bytes]]) -> None:
        """Takes of each context what it can share with another one of its anchor.

        All equal windows lie alike around the anchor, so nothing beyond the longest
        agreement to its left and to its right is ever part of one. What is left of two
        contexts is often the same string: all but its first place are copies, and only the
        first is compared with other strings. A single string holds each window once.
        """
        if len(rows) < 2:
            return
        left = _agreement([part[:lead][::-1] for _, _, lead, part in rows])
        right = _agreement([part[lead:] for _, _, lead, part in rows])
        firsts: dict[bytes, tuple[int, int]] = {}
        shared = [
            (doc, start + lead - a, part[lead - a : lead + b])
            for (doc, start, lead, part), a, b in zip(rows, left, right)
            if a + b >= self.length
        ]
        for doc, start, part in sorted(shared):
            if firsts.setdefault(part, (doc, start)) != (doc, start):
                self.copies.append((doc, start, start + len(part)))
        if len(firsts) < 2:
            return
        for part, (doc, start) in firsts.items():
            self.parts.append(part)
            self.docs.append(doc)
            self.starts.append(start)
            self.bytes += len(part)

    def covered(self) -> list[tuple[int, int, int]]:
        """Spans of windows that an earlier context holds too, as doc, first byte, end."""
        parts, length = self.parts, self.length
        if len(parts) < 2:
            return self.copies
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        first = np.concatenate([[0], np.cumsum(sizes + 1)])
        raw = np.frombuffer(b"\0".join([*parts, b""]), np.uint8)
        symbols = raw.astype(np.int16) + 2
        symbols[first[1:] - 1] = 1
        order = np.array(suffix_array(np.append(symbols, 0)))
        order = order[order < len(raw)]
        owner = np.searchsorted(first, order, side="right") - 1
        whole = order + length <= first[owner] + sizes[owner]
        order, owner = order[whole], owner[whole]
        # suffixes that share their first ``length`` bytes stand together
        seen = np.lib.stride_tricks.sliding_window_view(raw, length)
        same = np.zeros(len(order), bool)
        for a in range(1, len(order), 1 << 16):
            b = min(len(order), a + (1 << 16))
            same[a:b] = (seen[order[a:b]] == seen[order[a - 1 : b - 1]]).all(axis=1)
        kind = np.cumsum(~same)
        doc = np.array(self.docs, np.int64)[owner]
        place = np.array(self.starts, np.int64)[owner] + order - first[owner]
        rank = np.lexsort((place, doc, kind))
        late = np.concatenate([[False], kind[rank][1:] == kind[rank][:-1]]) if len(rank) else np.zeros(0, bool)
        d, p = doc[rank][late], place[rank][late]
        rank = np.lexsort((p, d))
        d, p = d[rank], p[rank]
        if not len(d):
            return self.copies
        lead = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] > p[:-1] + 1)]))
        last = np.append(lead[1:] - 1, len(d) - 1)
        return self.copies + list(zip(d[lead].tolist(), p[lead].tolist(), (p[last] + length).tolist()))


def _settled(length: int, large: int):
    """Spans from suffix arrays; windows of groups beyond ``large`` contexts go on one by one as hashes."""

    def out(spans, hashed=()):
        rows = [(d, a, b, None) for d, a, b in spans] + [(d, p, p + length, h) for d, p, h in hashed]
        columns = zip(*rows) if rows else ([], [], [], [])
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc", "start", "end", "window"])

    def apart(rows):
        for doc, start, _, part in rows:
            view = memoryview(part)
            yield from ((doc, start + i, xxhash.xxh3_128_digest(view[i : i + length])) for i in range(len(part) - length + 1))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, done, group, now, spread = _Windows(length), [], [], None, False
        for batch in stream:
            columns = (batch.column(c).to_pylist() for c in ("anchor", "doc", "start", "lead", "bytes"))
            for anchor, doc, start, lead, part in zip(*columns):
                if anchor != now:
                    if spread:
                        yield out([], apart(group))
                    else:
                        open_.add(group)
                    if open_.bytes >= ARRAY_BYTES or len(open_.copies) >= SPANS:
                        done += open_.covered()
                        open_ = _Windows(length)
                    if len(done) >= SPANS:
                        yield out(done)
                        done = []
                    group, now, spread = [], anchor, False
                group.append((doc, start, lead, part))
                if len(group) >= large:
                    spread = True
                    yield out([], apart(group))
                    group = []
        if spread:
            yield out([], apart(group))
        else:
            open_.add(group)
        yield out(done + open_.covered())

    return run


def _digests(keep: bool, length: int):
    """Counts and digest of what is left of each text; rows with open contexts pass through if ``keep``."""

    def finish(text: bytes, spans: np.ndarray):
        starts, ends = spans >> 32, spans & 0xFFFFFFFF
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
        lead = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]])) if len(starts) else np.zeros(0, np.int64)
        last = np.append(lead[1:] - 1, len(starts) - 1) if len(lead) else lead
        digest, at, removed = hashlib.sha256(), 0, 0
        for a, b in zip(starts[lead].tolist(), ends[last].tolist()):
            digest.update(text[at:a])
            at, removed = b, removed + b - a
        digest.update(text[at:])
        return len(text), removed, len(lead), digest.hexdigest()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in batches.pieces(stream, "text"):
            texts = batches.encoded(piece.column("text"))
            spans, pending = piece.column("spans"), piece.column("pending")
            rows, kept = [], []
            for i, text in enumerate(texts):
                waits = keep and pending[i].is_valid
                own = np.array(spans[i].as_py() or [], np.int64)
                rows.append((None, None, None, None) if waits else finish(text, own))
                kept.append(text if waits else None)
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            arrays = [piece.column("doc"), *columns]
            names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep:
                waiting = pa.array([t is None for t in kept])
                lists = [pc.if_else(waiting, pa.scalar(None, x.type), x) for x in (spans, pending)]
                arrays, names = [*arrays, pa.array(kept, pa.binary()), *lists], [*names, "text", "spans", "pending"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


_DIGEST = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _packed(start: Column, end: Column) -> Column:
    return F.shiftleft(start.cast("bigint"), 32) + end.cast("bigint")


def remove_repeats(
    df: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, large: int = LARGE_GROUP
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row.

    A byte is removed if it lies in a string of ``length`` bytes that also starts
    earlier, in a document of smaller id or further left in the same one, as the texts
    are given. ``n_spans`` counts the maximal runs removed.

    Every window of ``length`` bytes is known by its anchor, so only windows around
    equal anchors can be equal. Neighbouring windows of one anchor form a context.
    Contexts that are equal as a whole, found by hash next to the anchor's, need no
    comparison: all but the first go. Where an anchor has several distinct contexts,
    one of each is cut to what it can share, and the different strings that are left are
    compared by a suffix array over some such groups: suffixes that
    share ``length`` bytes stand together, and all but the first of them go. Groups of
    more than ``large`` contexts would not fit one array; their windows are counted by
    128-bit hash instead, which gives the same result spread over all tasks. Equal
    contexts of a slice of 2 MB are one before anything is shuffled.

    A null text is empty. If ids are null or repeat, documents are ordered by id (null
    first) and text, and equal rows stand one behind the other. Texts of any length go
    in blocks. An empty table gives an empty result; other columns are not read.
    """
    rows = df.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    unique = rows.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty()
    if unique:
        rows = rows.withColumn("doc", F.col("doc_id"))
    else:
        # numbers that rise with the order, fixed by writing them
        rows = staged(rows.orderBy("doc_id", "text").withColumn("doc", F.monotonically_increasing_id()))
    found = rows.select("doc", "text").mapInArrow(_anchored(length, anchor), ANCHORED)
    near = Window.partitionBy("anchor").orderBy("context", "doc", "start")
    found = found.withColumns({"before": F.lag("context").over(near), "after": F.lead("context").over(near)})
    found = staged(found.where("context is null or before is not null or after is not null"))
    settled = found.where("context is null or before <=> context")
    firsts = found.where("context is not null and not before <=> context")
    apart = Window.partitionBy("anchor").orderBy("context")
    firsts = firsts.withColumn("other", F.lag("doc").over(apart).isNotNull() | F.lead("doc").over(apart).isNotNull())
    span = _packed(F.col("start"), F.col("start") + F.col("windows") + (length - 1))
    spans = settled.groupBy("doc").agg(F.collect_list(span).alias("spans"))
    context = F.struct("anchor", "context", "start", "windows", "lead")
    pending = firsts.where("other").groupBy("doc").agg(F.collect_list(context).alias("pending"))
    joined = rows.select("doc", F.col("text").cast("binary").alias("text")).join(spans, "doc", "left").join(pending, "doc", "left")
    kind = "array<struct<anchor:bigint,context:bigint,start:int,windows:int,lead:int>>"
    first = staged(joined.mapInArrow(_digests(True, length), f"{_DIGEST}, text binary, spans array<bigint>, pending {kind}"))

    cut = F.transform(
        "pending",
        lambda p: F.struct(
            p["anchor"].alias("anchor"),
            p["context"].alias("context"),
            p["start"].alias("start"),
            p["lead"].alias("lead"),
            F.substring(F.col("text"), p["start"] + 1, p["windows"] + (length - 1)).alias("bytes"),
        ),
    )
    waiting = first.where("pending is not null")
    compared = waiting.select("doc", F.explode(cut).alias("c")).select("doc", "c.*")
    compared = compared.repartition("anchor").sortWithinPartitions("anchor", "context")
    result = staged(compared.mapInArrow(_settled(length, large), "doc long, start int, end int, window binary"))
    windows = result.where("window is not null")
    earliest = windows.groupBy("window").agg(F.min(F.struct("doc", "start")).alias("first"))
    late = windows.join(earliest, "window").where(F.struct("doc", "start") != F.col("first"))
    more = result.where("window is null").select("doc", "start", "end").unionByName(late.select("doc", "start", "end"))
    more = more.groupBy("doc").agg(F.collect_list(_packed(F.col("start"), F.col("end"))).alias("more"))
    both = F.concat(*[F.coalesce(c, F.array().cast("array<bigint>")) for c in (F.col("spans"), F.col("more"))])
    last = waiting.join(more, "doc", "left").select("doc", "text", both.alias("spans"), F.lit(None).cast("int").alias("pending"))
    last = last.mapInArrow(_digests(False, length), _DIGEST)
    digests = first.where("pending is null").select(last.columns).unionByName(last)
    if unique:
        return digests.withColumnRenamed("doc", "doc_id")
    return rows.select("doc", "doc_id").join(digests, "doc").select("doc_id", *last.columns[1:])
