"""Cross-entropy difference of two matched character models, each text scored by what the others say."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.llm import batches
from hazardlens.llm.staging import staged

BLOCK_BYTES = 8 << 20
SLICE_BYTES = 1 << 20

# three symbols to a number; symbol 0 stands before and after a text, any other is a code point plus one
BITS = 21
ONE, TWO = (1 << BITS) - 1, (1 << 2 * BITS) - 1
MODELS = ("target", "background")
LEVELS = ("n3", "total3", "kinds3", "n2", "total2", "kinds2", "n1")


def _blocks(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block of texts: number, ids, bytes of each text, and the texts compressed together."""
    number = TaskContext.get().partitionId() << 32
    for piece in batches.pieces(stream, "text", BLOCK_BYTES):
        texts = batches.encoded(piece.column("text"))
        ids = piece.column("_id")
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                pa.array([pa.compress(b"".join(texts), codec="zstd", asbytes=True)], pa.binary()),
            ],
            names=["_block", "ids", "sizes", "texts"],
        )
        number += 1


def _texts(sizes: list[int], compressed: bytes) -> list[bytes]:
    whole = pa.decompress(compressed, decompressed_size=sum(sizes), codec="zstd", asbytes=True)
    ends = np.cumsum(sizes).tolist()
    return [whole[end - size : end] for size, end in zip(sizes, ends)]


def _slices(texts: list[bytes]) -> Iterator[slice]:
    """Stretches of texts that hold about ``SLICE_BYTES``; a longer text is a stretch of its own."""
    begin = held = 0
    for i, text in enumerate(texts):
        if i > begin and held + len(text) > SLICE_BYTES:
            yield slice(begin, i)
            begin, held = i, 0
        held += len(text) + 1
    if texts:
        yield slice(begin, len(texts))


@dataclass
class Grams:
    """The trigram that ends at every character and text end, as text by text sorted runs."""

    text: np.ndarray
    gram: np.ndarray
    n: np.ndarray


def grams(texts: list[bytes]) -> Grams:
    """Distinct trigrams of every text with their counts, by text and trigram."""
    codes = [np.frombuffer(t.decode().encode("utf-32-le"), np.uint32) for t in texts]
    symbols = np.concatenate([part for c in codes for part in (c + np.uint32(1), np.zeros(1, np.uint32))]).astype(np.int64)
    number = np.repeat(np.arange(len(texts)), [len(c) + 1 for c in codes])
    known = np.flatnonzero(np.bincount(symbols))
    place = np.zeros(known[-1] + 1, np.int64)
    place[known] = np.arange(len(known))
    now = place[symbols]
    one = np.concatenate([[0], now[:-1]])
    two = np.concatenate([[0, 0], now[:-2]])[: len(now)]
    two[one == 0] = 0
    base = len(known)
    local = (two * base + one) * base + now
    found = []
    # as many texts at a time as their number and the trigram fit 62 bits together
    step = max(1, min(len(texts), (1 << 62) // base**3))
    firsts = np.searchsorted(number, np.arange(0, len(texts) + step, step))
    for a, b in zip(firsts, firsts[1:]):
        begin = number[a] if a < len(number) else 0
        keys = np.sort((number[a:b] - begin) * base**3 + local[a:b])
        lead = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        found.append((keys[lead] // base**3 + begin, keys[lead] % base**3, np.diff(np.append(lead, len(keys)))))
    text, key, n = (np.concatenate(parts) for parts in zip(*found))
    gram = known[key // base**2] << 2 * BITS | known[key // base % base] << BITS | known[key % base]
    return Grams(text, gram, n)


def _sampled(texts: list[bytes], share: float, seed: int) -> np.ndarray:
    """Whether each text trains the background: its hash lies in the first ``share`` of all hashes."""
    hashes = np.array([xxhash.xxh3_64_intdigest(t, seed) for t in texts], np.uint64)
    return hashes.astype(np.float64) < share * 2.0**64


def _marked(texts: list[bytes], places: list[int] | None, share: float, seed: int) -> np.ndarray:
    """Which texts train the target (row 0) and the background (row 1)."""
    marks = np.zeros((2, len(texts)), bool)
    marks[0, places or []] = True
    marks[1] = _sampled(texts, share, seed)
    return marks


def _counter(share: float, seed: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for row in batch.to_pylist():
                texts = _texts(row["sizes"], row["texts"])
                marks = _marked(texts, row["places"], share, seed)
                parts = []
                for stretch in _slices(texts):
                    g = grams(texts[stretch])
                    own = marks[:, stretch][:, g.text]
                    parts.append((g.gram, np.where(own[0], g.n, 0), np.where(own[1], g.n, 0)))
                gram, target, background = (np.concatenate(p) for p in zip(*parts))
                order = np.argsort(gram, kind="stable")
                gram = gram[order]
                lead = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "_block": np.full(len(lead), row["_block"]),
                        "gram": gram[lead],
                        "target": np.add.reduceat(target[order], lead),
                        "background": np.add.reduceat(background[order], lead),
                    }
                )

    return run


def model_table(counts: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """``gram`` with every number its probability needs under each model, and the sums over all symbols.

    ``counts`` has ``gram, target, background``. A level has the count of the trigram's
    last one, two or three symbols, and the total and the kinds of what follows the
    symbols before the last.
    """

    def after(table: DataFrame, key: str, level: int) -> DataFrame:
        sums = [F.sum(m).alias(f"{m}_total{level}") for m in MODELS]
        kinds = [F.count(F.when(F.col(m) > 0, 1)).alias(f"{m}_kinds{level}") for m in MODELS]
        return table.groupBy(F.shiftright(key, BITS).alias(f"before{level}")).agg(*sums, *kinds)

    twos = counts.groupBy(F.col("gram").bitwiseAND(F.lit(TWO)).alias("two")).agg(*(F.sum(m).alias(m) for m in MODELS))
    twos = staged(twos)
    ones = staged(twos.groupBy(F.col("two").bitwiseAND(F.lit(ONE)).alias("one")).agg(*(F.sum(m).alias(f"{m}_n1") for m in MODELS)))
    sums = ones.agg(
        F.count("*").alias("size"),
        *(F.coalesce(F.sum(f"{m}_n1"), F.lit(0)).alias(f"{m}_total") for m in MODELS),
        *(F.count(F.when(F.col(f"{m}_n1") > 0, 1)).alias(f"{m}_kinds") for m in MODELS),
    ).first()
    keyed = counts.select(
        "gram",
        *(F.col(m).alias(f"{m}_n3") for m in MODELS),
        F.shiftright("gram", BITS).alias("before3"),
        F.col("gram").bitwiseAND(F.lit(TWO)).alias("two"),
    )
    second = twos.select("two", *(F.col(m).alias(f"{m}_n2") for m in MODELS), F.shiftright("two", BITS).alias("before2"))
    second = second.withColumn("one", F.col("two").bitwiseAND(F.lit(ONE))).join(after(twos, "two", 2), "before2").join(ones, "one")
    joined = keyed.join(after(counts, "gram", 3), "before3").join(second, "two")
    return joined.select("gram", *(f"{m}_{c}" for m in MODELS for c in LEVELS)), sums.asDict()


def _within(text: np.ndarray, key: np.ndarray, n: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the sums of ``n`` and of ``last`` over the rows of its text with its key."""
    order = np.lexsort((key, text))
    t, k = text[order], key[order]
    lead = np.concatenate([[True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])])
    group = np.cumsum(lead) - 1
    back = np.empty(len(order), np.int64)
    back[order] = group
    return np.bincount(group, n[order])[back], np.bincount(group, last[order])[back]


def losses(g: Grams, found: dict[str, np.ndarray], sums: tuple[int, int, int], own: np.ndarray, texts: int) -> np.ndarray:
    """Sum of the negative log probabilities of each text's trigrams under one model.

    ``found`` has a model's numbers for every run of ``g``, ``sums`` are all symbols,
    their total and kinds. For texts where ``own`` holds, the numbers are those without
    the text itself. Witten-Bell interpolation from three symbols down to one and to a
    uniform distribution, so that no probability is zero.
    """
    number = {c: found[c].astype(np.float64) for c in LEVELS}
    size, total1, kinds1 = sums
    total1, kinds1 = np.full(len(g.n), float(total1)), np.full(len(g.n), float(kinds1))
    mine = np.flatnonzero(own[g.text])
    if len(mine):
        text, gram, n = g.text[mine], g.gram[mine], g.n[mine].astype(np.float64)

        def without(keys: np.ndarray, level: str, before: np.ndarray, counts: np.ndarray, once: np.ndarray) -> np.ndarray:
            """Takes the text's own counts of ``keys`` off; ``once`` marks one run of each key."""
            lost = once * (counts == number[f"n{level}"][mine])
            total, kinds = _within(text, before, n, lost)
            number[f"n{level}"][mine] -= counts
            return total, kinds

        def one_of_each(key: np.ndarray) -> np.ndarray:
            order = np.lexsort((key, text))
            first = np.concatenate([[True], (np.diff(text[order]) != 0) | (np.diff(key[order]) != 0)])
            out = np.zeros(len(order))
            out[order] = first
            return out

        nothing = np.zeros(len(mine))
        two, one = gram & TWO, gram & ONE
        own2, own1 = _within(text, two, n, nothing)[0], _within(text, one, n, nothing)[0]
        for level, key, before, counts, once in (
            ("3", gram, gram >> BITS, n, np.ones(len(mine))),
            ("2", two, two >> BITS, own2, one_of_each(two)),
            ("1", one, np.zeros(len(mine), np.int64), own1, one_of_each(one)),
        ):
            total, kinds = without(key, level, before, counts, once)
            if level == "1":
                total1[mine] -= total
                kinds1[mine] -= kinds
            else:
                number[f"total{level}"][mine] -= total
                number[f"kinds{level}"][mine] -= kinds

    def mixed(n, total, kinds, rest):
        return np.where(total > 0, (n + kinds * rest) / np.maximum(total + kinds, 1), rest)

    p = mixed(number["n1"], total1, kinds1, 1.0 / size)
    p = mixed(number["n2"], number["total2"], number["kinds2"], p)
    p = mixed(number["n3"], number["total3"], number["kinds3"], p)
    return np.bincount(g.text, -np.log(p) * g.n, minlength=texts)


def _scorer(sums: dict[str, int], share: float, seed: int, id: str):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        gram = right.column("gram").to_numpy()
        order = np.argsort(gram)
        gram = gram[order]
        numbers = {c: right.column(c).to_numpy()[order] for c in right.column_names if c not in ("_block", "gram")}
        for row in left.to_pylist():
            texts = _texts(row["sizes"], row["texts"])
            marks = _marked(texts, row["places"], share, seed)
            for stretch in _slices(texts):
                g = grams(texts[stretch])
                at = np.searchsorted(gram, g.gram)
                size = stretch.stop - stretch.start
                places = np.bincount(g.text, g.n, minlength=size)
                both = []
                for model, own in zip(MODELS, marks[:, stretch]):
                    found = {c: numbers[f"{model}_{c}"][at] for c in LEVELS}
                    known = sums["size"], sums[f"{model}_total"], sums[f"{model}_kinds"]
                    both.append(losses(g, found, known, own, size) / places)
                out.append((row["ids"][stretch], places.astype(np.int64) - 1, both[0], both[1], both[0] - both[1]))
        ids = pa.array([i for part in out for i in part[0]], left.schema.field("ids").type.value_type)
        rest = [pa.array(np.concatenate([part[k] for part in out])) for k in range(1, 5)]
        return pa.Table.from_arrays([ids, *rest], names=[id, "n_chars", "target_loss", "background_loss", "difference"])

    return run


def cross_entropy_difference(df: DataFrame, targets: DataFrame, id: str = "doc_id", text: str = "text", seed: int = 1) -> DataFrame:
    """``id, n_chars, target_loss, background_loss, difference`` of every row.

    Rows whose id is in the column ``id`` of ``targets`` train the target model. The
    background model is matched to it: a seeded share of all rows, chosen by the hash of
    the text, with about as many bytes as the target has. Both are character trigram
    models with the same smoothing over one vocabulary, all characters of the table and
    the text end. Losses are mean negative log likelihoods in nats per character, the
    end included; a negative difference means closer to the target. A text that trains
    a model is scored by that model without it (counts, totals and kinds less its own),
    so the score does not tell whether a text was in the training set. Other copies of
    it still count.

    Nothing is cut: vocabulary and counts are tables that grow with the input, and five
    sums go to the driver. Texts are written once in compressed blocks of about 8 MB. A
    block asks once for each of its distinct trigrams, gets their numbers, and scores
    its texts; ids meet ``targets`` without the texts. So what is shuffled is the
    compressed texts, once for each of counting and scoring, and two rows per block and
    trigram; no group is larger than a block.

    Null and empty texts have the text end alone. Null ids are in no target, repeated
    ids all are. Repeated rows count and are scored each. A text longer than a block is
    one of its own and needs memory in proportion. An empty table gives an empty result;
    without a target row both models are uniform. Other columns are not read.
    """
    rows = df.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["_id"]
    blocks = staged(rows.mapInArrow(_blocks, f"_block long, ids array<{kind}>, sizes array<long>, texts binary"))

    each = blocks.select("_block", F.posexplode(F.arrays_zip("ids", "sizes")).alias("place", "row"))
    each = each.select("_block", "place", F.col("row.ids").alias("_id"), F.col("row.sizes").alias("size"))
    wanted = targets.select(F.col(id).cast(kind).alias("_id")).where("_id is not null").distinct()
    places = staged(each.join(wanted, "_id").groupBy("_block").agg(F.collect_list("place").alias("places"), F.sum("size").alias("size")))
    # every text has an end, so that empty ones weigh too
    target = places.agg(F.coalesce(F.sum(F.col("size") + F.size("places")), F.lit(0))).first()[0]
    everything = blocks.agg(F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n + 1)), F.lit(0))).first()[0]
    share = target / everything if everything else 0.0

    marked = blocks.join(places.select("_block", "places"), "_block", "left")
    counted = marked.select("_block", "sizes", "texts", "places").mapInArrow(
        _counter(share, seed), "_block long, gram long, target long, background long"
    )
    counted = staged(counted)
    counts = staged(counted.groupBy("gram").agg(*(F.sum(m).alias(m) for m in MODELS)))
    model, sums = model_table(counts)
    answers = counted.select("_block", "gram").join(model, "gram")
    schema = f"{id} {kind}, n_chars long, target_loss double, background_loss double, difference double"
    return marked.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(_scorer(sums, share, seed, id), schema)
