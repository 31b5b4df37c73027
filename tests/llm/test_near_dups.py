"""Near-duplicates against all pairs in plain Python."""

import random
import re

import numpy as np
import pytest

from hazardlens.llm import batches, near_dups
from hazardlens.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall((text or "").encode().lower())
    if len(words) >= width:
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    return {tuple(words)} if words else set()


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            both = len(sets[a] & sets[b])
            if i is not None and j is not None and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(s), root(i), root(i) == i) for (i, _), s in zip(rows, sets) if i is not None}


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int")
    return near_dups.near_duplicates(df, **options).collect()


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize("width", [4, 5])
def test_equal_to_all_pairs(spark, width):
    rng = random.Random(width)
    common = " ".join(f"shared{i}" for i in range(30))
    rows = [(i, " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 60)))) for i in range(100, 140)]
    rows += [(200 + i, f"{common} " + " ".join(f"w{rng.random()}" for _ in range(10))) for i in range(30)]
    for group in range(3):
        base = [f"g{group}w{i}" for i in range(120)]
        # copies of many strengths around a base that is not the smallest id, so most are linked only through it
        rows += [(1000 * (group + 1) + i, edited(rng, base, rng.randint(0, 8))) for i in range(40)]
        rows.append((1000 * (group + 1) + 500, " ".join(base)))
    rows += [(1, None), (2, ""), (3, " \n "), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE two"), (8, "İ one two three")]
    rows += [(9, "word " * 30_000), (10, "word " * 20_000), (11, "x" * 300_000)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in run(spark, rows, width=width)}
    assert got == brute(rows, width, 80)


def test_star_centre_is_not_enough(spark):
    """A chain is linked only through its neighbours; two copies of a copy are found without the base."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for step in range(12):
        rows.append((100 - step, " ".join([f"n{i}" for i in range(step * 8)] + base[step * 8 :])))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in run(spark, rows, width=4)}
    assert got == brute(rows, 4, 80) and got[100][1] == 89


def test_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    got = run(spark, [(None, text), (3, text), (3, text), (5, text), (7, "other words")])
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, True), (3, 3, True), (3, 3, True), (5, 3, False), (7, 7, True)
    ]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_hot_copies(spark):
    rows = [(i, "the same words in every one of these texts") for i in range(3000)]
    got = run(spark, rows)
    assert {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


def test_densification_keeps_similarity():
    signatures = near_dups.Signatures()
    rng = np.random.default_rng(1)
    x = np.sort(rng.integers(1, 1 << 63, 90, dtype=np.uint64) * np.uint64(2))
    y = np.sort(np.concatenate([x[:72], rng.integers(1, 1 << 63, 18, dtype=np.uint64) * np.uint64(2)]))
    a, b = signatures.of([x, y])
    assert abs((a == b).mean() - 72 / 108) < 0.15
    assert (signatures.of([x[:1]]) == x[0]).all()


def test_words_hash_by_content():
    found = batches.words([b"Ab cd\nab", b"", b" CD "])
    h = found.hashes
    assert h[0] == h[2] and h[1] == h[3] and h[0] != h[1] and found.first().tolist() == [0, 3, 3, 4]


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
