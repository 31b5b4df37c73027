"""Vector codes against a plain version, with ties, odd rows and a count of what the pivots prune."""

import math
import random

import numpy as np
import pytest

from hazardlens.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, codes string, error string, _v int, _id int"


def plain(rows, parts, entries, rounds):
    """``[(id, codes, error)]`` and the codebooks, one distance at a time."""
    kept = [
        (i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def find(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for c in cut:
                members.setdefault(find(c[p], book)[1], []).append(c[p])
            books[p] = [[sum(x) // len(members[i]) for x in zip(*members[i])] if i in members else e for i, e in enumerate(book)]
    found = [[find(c[p], books[p]) for p in range(parts)] for c in cut]
    return [(i, [f[1] for f in row], sum(f[0] for f in row)) for (i, _), row in zip(kept, found)], books


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 0, "x", "y", 1, 2) for i, v in rows], SCHEMA).repartition(3)
    got = codes.compress(df, **how)
    return sorted(((r["vec_id"], r["codes"], r["error"]) for r in got.rows.collect()), key=str), got


@pytest.mark.parametrize("seed", range(3))
def test_codes_equal_plain_version(spark, seed):
    rng = random.Random(seed)
    scale = rng.choice([1.0, 0.01])  # the small scale makes many ties
    rows = [(i, [rng.gauss(0, scale) for _ in range(8)]) for i in range(60)]
    rows += [(5, rows[7][1]), (7, rows[7][1]), (None, rows[3][1]), (None, [0.0] * 8)]
    rows += [(100, None), (101, [1.0] * 7 + [None]), (102, [float("nan")] * 8), (103, [float("-inf")] + [0.0] * 7)]
    want, books = plain(rows, 4, 16, 4)
    got, found = run(spark, rows, entries=16, pivots=3)
    assert got == sorted(want, key=str)
    assert found.codebooks.tolist() == books


def test_odd_tables(spark):
    got, found = run(spark, [])
    assert got == [] and found.codebooks.shape == (4, 0, 0)
    got, found = run(spark, [(1, None)])
    assert got == [] and found.codebooks.size == 0
    got, _ = run(spark, [(i, [0.25] * 8) for i in range(5)])  # all equal: the first entry takes all
    assert got == [(i, [0, 0, 0, 0], 0) for i in range(5)]
    got, _ = run(spark, [(1, []), (2, [])])
    assert got == [(1, [0, 0, 0, 0], 0), (2, [0, 0, 0, 0], 0)]
    got, _ = run(spark, [(1, [1.0] * 8), (2, [1.0] * 12), (3, [1.0] * 9)])  # other lengths take no part
    assert [r[0] for r in got] == [1]
    with pytest.raises(Exception, match="component"):
        run(spark, [(1, [1e30] * 8)])


def test_long_vectors_and_labels(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-200000, 200000) for _ in range(400)]) for i in range(12)]  # beyond 2^53 squared
    want, _ = plain(rows, 4, 4, 4)
    assert run(spark, rows, entries=4)[0] == sorted(want, key=str)
    df = spark.createDataFrame([(1, [0.5] * 4, None), (2, [0.25] * 4, "a")], "vec_id long, embedding array<float>, label string")
    kept = codes.compress(df, keep=("label",), rounds=0).rows
    assert kept.columns == ["vec_id", "label", "codes", "error"]
    assert {(r["vec_id"], r["label"]) for r in kept.collect()} == {(1, None), (2, "a")}


def test_restore_gives_the_entries(spark):
    rows = [(i, [i / 4] * 8) for i in range(4)]
    _, found = run(spark, rows)
    back = {r["vec_id"]: r["vector"] for r in codes.restore(found.rows, found.codebooks).collect()}
    assert back == {i: [256 * i] * 8 for i in range(4)}  # four vectors, four entries: nothing is lost


def test_pivots_prune_and_change_nothing():
    rng = np.random.default_rng(3)
    centres = rng.integers(-3000, 3000, (256, 16))
    x = centres[rng.integers(0, 256, 2000)] + rng.integers(-60, 60, (2000, 16))
    pivots = codes.choose_pivots(centres, 8)
    near = codes.distances(x, pivots).astype(np.float32).astype(np.float64)
    at = codes.distances(centres, pivots).astype(np.float32).astype(np.float64)
    code, best, tried = codes.nearest(x, near, centres, at)
    every = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (code == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert tried < 0.1 * every.size
