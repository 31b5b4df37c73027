"""Near-duplicate documents: one-permutation hashing, banded buckets, star-shaped candidate edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.llm import batches
from hazardlens.llm.components import components
from hazardlens.llm.staging import staged

WIDTH = 5
PERCENT = 80
ROWS = 7
BANDS = 48
# star rounds go on while more than one edge in so many holds
WORTH = 8

_rng = np.random.Generator(np.random.PCG64(7))
_ODD = _rng.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)


def shingle_sets(words: batches.Words, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text; fewer words than ``width`` are one shingle."""
    first = words.first()
    h, n = words.hashes, len(words.hashes)
    if n >= width:
        run = h[: n - width + 1] * _ODD[0]
        for j in range(1, width):
            run = run + h[j : n - width + 1 + j] * _ODD[j]
        run = batches.mix(run)
    else:
        run = np.zeros(0, np.uint64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            found = np.sort(run[a : b - width + 1])
            out.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
        elif b > a:
            short = np.concatenate([h[a:b] * _ODD[: b - a], _ODD[width + b - a :][:1]])
            out.append(batches.mix(short.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Signatures:
    """One permutation, ``bands * rows`` bins, empty bins filled from others.

    A set's hashes are dealt into bins by their size and each bin keeps its smallest.
    An empty bin takes the value of the first full one along its own fixed random order
    of bins, the same for every set: the densification with the least variance.
    """

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        rng = np.random.Generator(np.random.PCG64(11))
        self.order = np.argsort(rng.random((self.bins, self.bins)), axis=1).astype(np.int32)
        self.span = np.uint64((1 << 64) // self.bins + 1)

    def of(self, sets: list[np.ndarray]) -> np.ndarray:
        """Signatures of sets that are not empty, one row each."""
        values = np.zeros((len(sets), self.bins), np.uint64)
        full = np.zeros((len(sets), self.bins), bool)
        for row, found in enumerate(sets):
            place = (found // self.span).astype(np.int64)
            lead = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            values[row, place[lead]] = found[lead]
            full[row, place[lead]] = True
            if len(lead) == 1:
                values[row], full[row] = found[0], True
        rows, bins = np.nonzero(~full)
        for step in range(self.bins):
            if not len(rows):
                break
            source = self.order[bins, step]
            good = full[rows, source]
            values[rows[good], bins[good]] = values[rows[good], source[good]]
            rows, bins = rows[~good], bins[~good]
        return values

    def keys(self, values: np.ndarray) -> np.ndarray:
        """One hash per band, which differs from band to band."""
        cells = values.reshape(len(values), self.bands, self.rows)
        sums = (cells * _ODD[: self.rows]).sum(axis=2, dtype=np.uint64)
        return batches.mix(sums + _ODD[64 : 64 + self.bands]).view(np.int64)


def _signed(id: str, text: str, width: int, bands: int, rows: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures(bands, rows)
        for piece in batches.pieces(stream, text):
            sets = shingle_sets(batches.words(batches.encoded(piece.column(text))), width)
            filled = [i for i, s in enumerate(sets) if len(s)]
            keys = signatures.keys(signatures.of([sets[i] for i in filled])) if filled else np.zeros((0, bands), np.int64)
            sizes = np.fromiter((bands if len(s) else 0 for s in sets), np.int32, len(sets))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(id),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(keys.ravel())),
                ],
                names=["doc_id", "n_shingles", "set_hash", "bands"],
            )

    return run


def _sets(id: str, text: str, width: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in batches.pieces(stream, text):
            sets = shingle_sets(batches.words(batches.encoded(piece.column(text))), width)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([piece.column(id), lists], names=["node", "members"])

    return run


def _confirm(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidate edges with ``linked``, from the full sets of both ends."""
    ends = edges.join(sets.select("node", F.col("members").alias("_y")), "node").join(
        sets.select(F.col("node").alias("center"), F.col("members").alias("_x")), "center"
    )
    both = F.size(F.array_intersect("_x", "_y"))
    linked = both * 100 >= (F.size("_x") + F.size("_y") - both) * percent
    return staged(ends.select("center", "node", linked.alias("linked")).groupBy("center", "node").agg(F.max("linked").alias("linked")))


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    return nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _open(buckets: DataFrame, labels: DataFrame, used: DataFrame | None) -> DataFrame:
    """Members of buckets of several components that are not in the component of a centre they had."""
    named = _labelled(buckets, labels)
    if used is not None:
        had = _labelled(used.withColumnRenamed("center", "node"), labels).select("key", "label").distinct()
        named = named.join(had, ["key", "label"], "left_anti")
    keys = named.groupBy("key").agg(F.min("label").alias("_l"), F.max("label").alias("_h")).where("_l <> _h")
    return named.join(keys.select("key"), "key")


def _centers(members: DataFrame, key: str) -> DataFrame:
    """The member of the highest degree of each key, ties to the smallest."""
    first = F.max(F.struct("degree", -F.col("node"), "node", "n_shingles", "label")).alias("c")
    best = members.groupBy(key).agg(first)
    return best.select(key, F.col("c.node").alias("center"), F.col("c.n_shingles").alias("_n"), F.col("c.label").alias("_label"))


def _pairs(rows: DataFrame, tested: DataFrame | None) -> DataFrame:
    pairs = rows.select(F.least("center", "node").alias("center"), F.greatest("center", "node").alias("node")).distinct()
    return staged(pairs if tested is None else pairs.join(tested, ["center", "node"], "left_anti"))


def _first_shingles(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rarest shingles of each node with their place in the order of rarity.

    As many as must be looked at so that a node that is similar enough shares one.
    """
    single = nodes.join(sets, "node").select("node", F.explode("members").alias("shingle"))
    rarity = single.groupBy("shingle").agg(F.count("*").alias("f"))
    ranked = single.join(rarity, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("f", "shingle"))).alias("r"))
    size = F.size("r")
    most = size - F.ceil(size * percent / 100).cast("int") + 1
    first = ranked.select("node", size.alias("n"), F.slice("r", F.lit(1), most)["shingle"].alias("first"))
    return first.select("node", "n", F.posexplode("first").alias("at", "shingle"))


def _remaining(mixed: DataFrame, sets: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components among these nodes that can be similar enough.

    Two nodes can only reach the similarity if they share one of the first shingles of
    both in the order of rarity, early enough that what follows still suffices (prefix
    and position filter; the shorter one needs an even shorter prefix). Copies that are
    far from all others have so many rare shingles of their own that nothing is left to
    share. The members of the largest component of a bucket are not compared with each
    other, which spares most pairs of a common shingle.
    """
    nodes = staged(mixed.groupBy("node").agg(F.min("label").alias("label"), F.max("apart").alias("apart")))
    placed = staged(_first_shingles(nodes.select("node"), sets, percent).join(nodes, "node"))
    x, y = placed.where("apart").alias("x"), placed.alias("y")
    short = "least(x.n, y.n)"
    # the shorter of two needs to share within this many
    brief = f"{short} - ceil({2 * percent} * {short} / {100 + percent}) + 1"
    at_short = "if(struct(x.n, x.node) < struct(y.n, y.node), x.at, y.at)"
    reach = f"{100 + percent} * least(x.n - x.at, y.n - y.at) >= {percent} * (x.n + y.n)"
    fit = f"x.label <> y.label and 100 * {short} >= {percent} * greatest(x.n, y.n) and {at_short} < {brief} and {reach}"
    found = x.join(y, F.expr(f"x.shingle = y.shingle and {fit}"))
    return _pairs(found.select(F.col("x.node").alias("center"), F.col("y.node").alias("node")), tested)


def _near_labels(judged: DataFrame) -> DataFrame:
    """For every node of a link the smallest node within two links."""
    links = judged.where("linked").select(F.col("center").alias("a"), F.col("node").alias("b"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    one = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
    two = both.join(one, "b").groupBy("a").agg(F.min("m").alias("m"))
    return staged(two.select(F.col("a").alias("node"), F.least("a", "m").alias("label")))


def _roots(judged: DataFrame) -> DataFrame:
    """The smallest node that can be reached, for every node of a link.

    Links inside a star vanish with its label; only what is left between labels is
    followed further.
    """
    near = _near_labels(judged)
    left = judged.where("linked").join(near, "node").select("center", F.col("label").alias("b"))
    left = left.join(near.select(F.col("node").alias("center"), F.col("label").alias("a")), "center").where("a <> b")
    roots = components(left, "a", "b").withColumnRenamed("node", "label")
    return near.join(roots, "label", "left").select("node", F.coalesce("component", "label").alias("label"))


def near_duplicates(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Two documents are linked if their sets of ``width``-word shingles (A-Z read as a-z)
    share ``percent`` of their union; ``component_id`` is the smallest id that can be
    reached over links, and the document of that id is kept.

    Equal sets are one node from the start. Nodes that agree in all rows of a band fall
    into a bucket. Per bucket, edges go from its best connected member to those that are
    not yet in its component, and each edge is confirmed on the full sets. Members still
    apart get a centre among themselves, as long as that links a fair share. Then the pairs left,
    of different components in one bucket, are found by a prefix and position filter
    and confirmed too, so no bucket is cut and no link within one is lost; no bucket is
    expanded into all its pairs.
    A link of exactly 80 % shares no band with a probability of about one in 80,000.

    A text without words (null, empty, blank) has no shingles and is linked with nothing.
    Rows with a null id take no part: null component, kept. Repeated ids are judged row
    by row. An empty table gives an empty result; other columns are not read.
    """
    rows_in = df.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_shingles long, set_hash binary, bands array<bigint>"
    signed = staged(rows_in.mapInArrow(_signed("doc_id", "text", width, bands, rows), schema))
    part = signed.where("doc_id is not null and set_hash is not null")
    nodes = part.groupBy("set_hash").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("n"))
    keys = nodes.select(F.col("n.doc_id").alias("node"), "n.n_shingles", F.explode("n.bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    found = staged(keys.join(shared, "key"))
    degrees = found.groupBy("node").agg(F.sum("size").alias("degree"))
    buckets = staged(found.join(degrees, "node").select("key", "node", "n_shingles", "degree"))
    active = rows_in.withColumnRenamed("doc_id", "node").join(degrees.select("node"), "node", "left_semi")
    sets = staged(active.mapInArrow(_sets("node", "text", width), "node long, members array<bigint>").where("size(members) > 0"))

    members, used, tested = buckets.withColumn("label", F.col("node")), None, None
    near = F.least("n_shingles", "_n") * 100 >= F.greatest("n_shingles", "_n") * percent
    while True:
        best = _centers(members, "key")
        star = members.join(best, "key").where(near & (F.col("label") != F.col("_label")))
        judged = _confirm(_pairs(star, tested), sets, percent)
        used = best.select("key", "center") if used is None else used.unionByName(best.select("key", "center"))
        used, tested = staged(used), judged if tested is None else staged(tested.unionByName(judged))
        labels = _near_labels(tested)
        count = judged.agg(F.count("*").alias("all"), F.count(F.when(F.col("linked"), 1)).alias("good")).first()
        members = staged(_open(buckets, labels, used))
        if count["good"] * WORTH <= count["all"]:
            break
    mixed = _open(buckets, labels, None)
    apart = mixed.join(_centers(mixed, "key").select("key", "_label"), "key").withColumn("apart", F.col("label") != F.col("_label"))
    judged = _confirm(_remaining(apart, sets, tested, percent), sets, percent)
    labels = _roots(tested.unionByName(judged))

    names = part.groupBy("set_hash").agg(F.min("doc_id").alias("node"))
    classes = names.join(labels, "node", "left").select("set_hash", F.coalesce("label", "node").alias("_component"))
    result = signed.drop("bands").join(classes, "set_hash", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))
    )
