"""Document quality by attention-based multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.llm import batches

PASSAGE = 64
LABELLED = 3000
HIDDEN = 16
ATTENTION = 8
STEPS = 250
RATE = 0.03
CUT = 0.7

# groups of bytes whose shares describe a passage
GROUPS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b".",
    b",;:",
    b"!?",
    b"#*$%&",
    b"|<>{}[]\\^~_=",
    b"\"'()-/@+",
    bytes(range(128, 256)),
)
_GROUP = np.full(256, len(GROUPS), np.int64)
for _place, _members in enumerate(GROUPS):
    _GROUP[list(_members)] = _place
N_FEATURES = len(GROUPS) + 6


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of ``PASSAGE`` words, and where each text's passages begin.

    A text without words is one passage of zeros. Shares of character groups, mean word
    length, share of distinct words, of long words and of words as the one before, line
    breaks per word, and how full the passage is.
    """
    found = batches.words(texts)
    first = found.first()
    count = np.diff(first)
    parts = np.maximum(1, -(-count // PASSAGE))
    begin = np.concatenate([[0], np.cumsum(parts)])
    out = np.zeros((begin[-1], N_FEATURES), np.float64)
    n = len(found.starts)
    if not n:
        return out, begin
    inside = np.arange(n) - first[found.text]
    owner = begin[found.text] + inside // PASSAGE
    lengths = (found.ends - found.starts).astype(np.float64)
    total = np.bincount(owner, minlength=len(out)).astype(np.float64)
    chars = np.bincount(owner, lengths, len(out))
    whole = np.concatenate([[0], np.cumsum(lengths).astype(np.int64)])
    place = np.arange(whole[-1]) + np.repeat(found.starts - whole[:-1], lengths.astype(np.int64))
    group = _GROUP[found.data[place]]
    cells = np.bincount(np.repeat(owner, lengths.astype(np.int64)) * (len(GROUPS) + 1) + group, minlength=len(out) * (len(GROUPS) + 1))
    some, letters = np.maximum(total, 1), np.maximum(chars, 1)
    out[:, : len(GROUPS)] = cells.reshape(len(out), -1)[:, :-1] / letters[:, None]
    order = np.lexsort((found.hashes, owner))
    fresh = np.ones(n, bool)
    fresh[1:] = (found.hashes[order][1:] != found.hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    again = np.zeros(n, bool)
    again[1:] = (found.hashes[1:] == found.hashes[:-1]) & (owner[1:] == owner[:-1])
    breaks = np.zeros(n, np.float64)
    line = np.concatenate([[0], np.cumsum(found.data == 10)])
    breaks[1:] = line[found.starts[1:]] - line[found.ends[:-1]]
    extra = (
        chars / some / 10,
        np.bincount(owner[order], fresh, len(out)) / some,
        np.bincount(owner, lengths > 20, len(out)) / some,
        np.bincount(owner, again, len(out)) / some,
        np.minimum(np.bincount(owner, breaks, len(out)) / some, 1),
        total / PASSAGE,
    )
    out[:, len(GROUPS) :] = np.stack(extra, axis=1)
    return out, begin


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Encoder, gated attention and output weights, and the scale of the features; ``learned``
    is the number of documents they are learned from."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    learned: int = 0

    def forward(self, x: np.ndarray, begin: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.tanh(((x - self.mean) / self.scale) @ w["encode"] + w["encode0"])
        v, u = np.tanh(h @ w["value"]), _sigmoid(h @ w["gate"])
        raw = (v * u) @ w["attend"]
        bag = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        e = np.exp(raw - np.maximum.reduceat(raw, begin[:-1])[bag])
        a = e / np.add.reduceat(e, begin[:-1])[bag]
        z = np.add.reduceat(h * a[:, None], begin[:-1])
        score = _sigmoid(z @ w["out"] + w["out0"])
        return {"h": h, "v": v, "u": u, "bag": bag, "a": a, "z": z, "score": score}

    def score(self, texts: list[bytes]) -> np.ndarray:
        x, begin = passages(texts)
        return self.forward(x, begin)["score"]


def _shapes(features: int) -> dict[str, tuple[int, ...]]:
    return {
        "encode": (features, HIDDEN),
        "encode0": (HIDDEN,),
        "value": (HIDDEN, ATTENTION),
        "gate": (HIDDEN, ATTENTION),
        "attend": (ATTENTION,),
        "out": (HIDDEN,),
        "out0": (),
    }


def fit(x: np.ndarray, begin: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 5) -> Model:
    """Gradient descent on the log loss of the documents; passages have no labels of their own."""
    rng = np.random.Generator(np.random.PCG64(seed))
    shapes = _shapes(x.shape[1])
    weights = {k: np.asarray(rng.normal(0, 0.3, s)) for k, s in shapes.items()}
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-3, weights, len(labels))
    scaled = (x - model.mean) / model.scale
    moments = {k: (np.zeros(s), np.zeros(s)) for k, s in shapes.items()}
    for step in range(1, steps + 1):
        f, w = model.forward(x, begin), weights
        bag, h, a = f["bag"], f["h"], f["a"]
        error = (f["score"] - labels) / len(labels)
        dz = error[:, None] * w["out"]
        da = (dz[bag] * h).sum(axis=1)
        draw = a * (da - np.add.reduceat(a * da, begin[:-1])[bag])
        gated = draw[:, None] * w["attend"]
        dv, du = gated * f["u"] * (1 - f["v"] ** 2), gated * f["v"] * f["u"] * (1 - f["u"])
        dh = (dz[bag] * a[:, None] + dv @ w["value"].T + du @ w["gate"].T) * (1 - h**2)
        gradient = {
            "encode": scaled.T @ dh,
            "encode0": dh.sum(axis=0),
            "value": h.T @ dv,
            "gate": h.T @ du,
            "attend": (f["v"] * f["u"]).T @ draw,
            "out": f["z"].T @ error,
            "out0": error.sum(),
        }
        for k, g in gradient.items():
            g = g + 1e-4 * w[k]
            m, s = moments[k]
            moments[k] = m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
            w[k] = w[k] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return model


def _constant(rate: float, learned: int) -> Model:
    """A model that gives every text one score."""
    weights = {k: np.zeros(s) for k, s in _shapes(N_FEATURES).items()}
    weights["out0"] = np.asarray(np.log(rate / (1 - rate)))
    return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), weights, learned)


def _encoded(text: str):
    """Features of all passages of each row."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in batches.pieces(stream, text):
            x, begin = passages(batches.encoded(piece.column(text)))
            rows = [x[a:b].astype(np.float32).tobytes() for a, b in zip(begin[:-1], begin[1:])]
            columns = [piece.column("quality"), piece.column("doc_id"), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["quality", "doc_id", "x"])

    return run


def held_out(id: Column) -> Column:
    """Rows whose labels may not be learned from: the crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(id.cast("string")) % 4 == 2, F.lit(False))


def train(
    documents: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    labelled: int = LABELLED,
) -> Model:
    """A model from at most ``labelled`` documents, all passages of each.

    The documents are those with the smallest hash of their id among the labelled ones
    that are not held out. Null labels and ids are left out, of several labels the
    largest counts. With one class only the model gives every text the smoothed share
    of label 1 (one half without any label).
    """
    known = labels.select(F.col(id).cast("bigint").alias("doc_id"), F.col(quality).cast("int").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    texts = documents.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    # at most ``labelled`` rows of two numbers, whatever the input
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = sample.mapInArrow(_encoded("text"), "quality int, doc_id long, x binary").toArrow().sort_by("doc_id")
    y = np.array(rows["quality"].to_pylist(), np.float64)
    if not len(y) or y.min() == y.max():
        return _constant((y.sum() + 1) / (len(y) + 2), len(y))
    parts = [np.frombuffer(x, np.float32).reshape(-1, N_FEATURES) for x in rows["x"].to_pylist()]
    begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return fit(np.concatenate(parts).astype(np.float64), begin, (y > 0).astype(np.float64))


def score(df: DataFrame, model: Model, text: str = "text", cut: float = CUT) -> DataFrame:
    """``df`` with ``score`` (0 to 1, higher is better) and ``predicted`` (1 from ``cut`` up).

    Every passage of the whole text is encoded; the gated attention weighs them. Null,
    empty and blank texts are one passage of zeros. Input columns named as the results
    are replaced; an empty table gives an empty result.
    """

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        out = []
        for piece in batches.pieces(iter([pa.RecordBatch.from_pydict({"t": pa.array(texts, pa.string())})]), "t"):
            out.append(model.score(batches.encoded(piece.column("t"))))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return df.withColumn("score", scored(F.col(text))).withColumn("predicted", (F.col("score") >= cut).cast("int"))
