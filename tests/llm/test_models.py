"""Quality model by held-out accuracy, cross-entropy difference against plain counts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from hazardlens.llm import lm, quality_model
from hazardlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    scored = QUERIES["op8_quality_model"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null")
    rows = scored.join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows} == {True}
    assert len(held) > 500
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.98
    good = [r for r in held if r["quality"] == 1]
    assert sum(r["predicted"] for r in good) / len(good) > 0.99


def test_every_text_gets_a_score(spark):
    rows = [(1, None, 5), (2, "", 5), (3, " \n", 5), (4, "word " * 100_000, 5), (None, "a b", 5), (4, "x" * 300_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 1)], "doc_id long, quality int")
    model = quality_model.train(df, labels)
    got = quality_model.score(df, model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    assert quality_model.score(df.limit(0), model).count() == 0


def test_one_class_or_no_label(spark):
    df = spark.createDataFrame([(i, "a b c") for i in range(20)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality_model.score(df, quality_model.train(df, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    scores = {r["score"] for r in quality_model.score(df, quality_model.train(df, ones)).collect()}
    assert len(scores) == 1 and scores.pop() > 0.8


def test_training_sees_every_passage(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(n))) for i, n in enumerate([5000, 40, 3000, 0] * 5)]
    seen = {}
    monkeypatch.setattr(quality_model, "fit", lambda x, begin, y: seen.update(x=x, begin=begin, y=y))
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    quality_model.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    used = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    x, begin = quality_model.passages([t.encode() for _, t in used])
    assert seen["begin"].tolist() == begin.tolist() and max(np.diff(begin)) == 79
    assert np.allclose(seen["x"], x, atol=1e-6) and seen["y"].tolist() == [i % 2 for i, _ in used]


def test_gradient_fits_attention():
    """One bad passage among good ones makes a document bad; attention must find it."""
    rng = np.random.default_rng(1)
    begin, rows, labels = [0], [], []
    for _ in range(300):
        n = rng.integers(1, 12)
        x = rng.normal(0, 1, (n, quality_model.N_FEATURES))
        label = int(rng.random() < 0.5)
        if not label:
            x[rng.integers(n), 0] = 6
        rows.append(x)
        labels.append(label)
        begin.append(begin[-1] + n)
    x, begin, labels = np.concatenate(rows), np.array(begin), np.array(labels, float)
    model = quality_model.fit(x, begin, labels)
    assert ((model.forward(x, begin)["score"] > 0.5) == labels).mean() > 0.95
    a = model.forward(x, begin)["a"]
    assert np.allclose(np.add.reduceat(a, begin[:-1]), 1)


def plain_losses(rows, share, seed=1):
    """The losses by counting all texts anew without the one that is scored; rows are ``(id, text, target)``."""

    def grams(text):
        s = [0, 0, *(ord(c) + 1 for c in text), 0]
        return [tuple(s[i : i + 3]) for i in range(len(s) - 2)]

    size = len({g[2] for _, t, _ in rows for g in grams(t)})

    def loss(training, text):
        levels = [Counter(g[2 - k :] for t in training for g in grams(t)) for k in range(3)]
        total = [Counter() for _ in range(3)]
        kinds = [Counter() for _ in range(3)]
        for k, level in enumerate(levels):
            for g, n in level.items():
                total[k][g[:-1]] += n
                kinds[k][g[:-1]] += 1
        out = 0.0
        for gram in grams(text):
            p = 1 / size
            for k, level in enumerate(levels):
                g = gram[2 - k :]
                if total[k][g[:-1]]:
                    p = (level[g] + kinds[k][g[:-1]] * p) / (total[k][g[:-1]] + kinds[k][g[:-1]])
            out -= math.log(p)
        return out / (len(text) + 1)

    chosen = lm._sampled([t.encode() for _, t, _ in rows], share, seed)
    target = [(i, t) for i, (_, t, m) in enumerate(rows) if m]
    background = [(i, t) for i, ((_, t, _), c) in enumerate(zip(rows, chosen)) if c]
    return [
        (doc, len(text), *(loss([t for j, t in part if j != i], text) for part in (target, background)))
        for i, (doc, text, _) in enumerate(rows)
    ]


@pytest.mark.parametrize("alphabet,part", [("aab cé🎉\0", 0.3), ("ab", 0.8), ("".join(map(chr, range(0x4E00, 0x4F40))), 0.5), ("xyz", 0)])
def test_losses_equal_plain_counts(spark, monkeypatch, alphabet, part):
    rng = random.Random(len(alphabet))
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))), rng.random() < part) for i in range(50)]
    rows += [(7, rows[7][1], rows[7][2]), (7, "other", rows[7][2]), (None, "no id", False), (None, rows[3][1], False)]
    weigh = lambda kept: sum(len(t.encode()) + 1 for _, t, m in rows if kept(m))
    want = plain_losses(rows, weigh(bool) / weigh(lambda m: True))
    df = spark.createDataFrame([(i, t, 0, 0.5, b"x") for i, t, _ in rows], "doc_id long, text string, n_chars int, target double, texts binary")
    targets = spark.createDataFrame([(i,) for i, _, m in rows if m] * 2 + [(None,), (99,)], "doc_id long")
    got = lm.cross_entropy_difference(df.repartition(5), targets).collect()
    key = lambda r: (str(r[0]), r[1], round(r[2], 6), round(r[3], 6))
    for a, b in zip(sorted(want, key=key), sorted((tuple(r) for r in got), key=key), strict=True):
        assert a[:2] == b[:2]
        assert b[2:4] == pytest.approx(a[2:], rel=1e-9) and b[4] == pytest.approx(a[2] - a[3], abs=1e-9)


def test_nulls_long_texts_and_no_target(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (None, "ab\0" * 1_000_000), (2, "é" * 9_000_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    got = lm.cross_entropy_difference(df, none).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 3_000_000, 9_000_000] and all(r["difference"] == 0 for r in got)
    got = lm.cross_entropy_difference(df, df.select("doc_id")).collect()
    assert len(got) == 4 and all(math.isfinite(r["difference"]) for r in got)
    assert lm.cross_entropy_difference(df.limit(0), none).count() == 0


def test_slices_and_many_symbols(monkeypatch):
    """The trigrams of many texts are the same in one go, in slices and with numbers too large for one go."""
    rng = random.Random(2)
    texts = ["".join(chr(rng.choice([97, 98, 0x4E00 + rng.randrange(20000)])) for _ in range(rng.randrange(50))) for _ in range(300)]
    got = lm.grams([t.encode() for t in texts])
    want = Counter()
    for i, t in enumerate(texts):
        s = [0, 0, *(ord(c) + 1 for c in t), 0]
        want.update((i, s[k] << 42 | s[k + 1] << 21 | s[k + 2]) for k in range(len(s) - 2))
    assert dict(zip(zip(got.text.tolist(), got.gram.tolist()), got.n.tolist())) == want
    monkeypatch.setattr(lm, "SLICE_BYTES", 100)
    stretches = list(lm._slices([t.encode() for t in texts]))
    assert [i for s in stretches for i in range(s.start, s.stop)] == list(range(300)) and len(stretches) > 50


def test_random_flags_tell_nothing(spark):
    """Training texts are not told from others where there is nothing to tell."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(120)), rng.random() < 0.3) for i in range(300)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    flagged = spark.createDataFrame([(i,) for i, _, m in rows if m], "doc_id long")
    got = {r["doc_id"]: r["difference"] for r in lm.cross_entropy_difference(df, flagged).collect()}
    mean = lambda flag: np.mean([got[i] for i, _, m in rows if m == flag])
    spread = np.std(list(got.values()))
    assert abs(mean(True) - mean(False)) < spread and spread < 0.1


def test_rare_characters_are_told_apart(spark, tmp_path):
    """Two groups of documents in characters beyond the 128 most frequent."""
    rng = random.Random(5)
    common = "".join(chr(0x400 + i) for i in range(128))
    rows = [(i, common * 50) for i in range(8)]
    for i in range(8, 40):
        rows.append((i, " ".join(chr(0x4E00 + 50 * (i % 2) + rng.randrange(50)) for _ in range(60))))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    good = [(i, 1) for i in range(8, 24, 2)]
    spark.createDataFrame(good, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r["doc_id"]: r["difference"] for r in QUERIES["op10_cross_entropy"](spark, str(tmp_path)).collect()}
    assert max(got[i] for i in range(24, 40, 2)) < min(got[i] for i in range(25, 40, 2)) - 0.5
