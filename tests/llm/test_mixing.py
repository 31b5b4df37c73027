"""Budgets down the tree and prefixes of epochs against plain Python."""

import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import pytest

from hazardlens.llm import mixing

LEVELS = {"domain": "domain", "lang": "lang", "source": "source"}
WEIGHTS = {"domain": "case domain when 'a' then 3 when 'z' then 0 else 1 end", "source": "case source when 's1' then 5 else 2 end"}


def weight(path):
    level = len(path)
    if level == 1:
        return {"a": 3, "z": 0}.get(path[0], 1)
    return 1 if level == 2 else 5 if path[2] == "s1" else 2


def share(siblings, given):
    """``{node: (capacity, weight)}`` shared by repeated passes: whoever is full drops out."""
    out, open_ = {}, dict(siblings)
    while open_:
        total = sum(w for _, w in open_.values())
        full = [n for n, (c, w) in open_.items() if c * total <= w * given]
        # the least served first, one at a time
        full.sort(key=lambda n: (Fraction(open_[n][0], open_[n][1]) if open_[n][1] else 0, n))
        if not full:
            return out | {n: w * given // total for n, (_, w) in open_.items()}
        c, _ = open_.pop(full[0])
        out[full[0]] = c
        given -= c
    return out


def brute(rows, percent, epochs, seed):
    leaves = defaultdict(list)
    for i, *path, text in rows:
        if text and text.split():
            leaves[tuple(p or "(none)" for p in path)].append((i, len(text.split())))
    tokens = {p: sum(n for _, n in docs) for p, docs in leaves.items()}
    room = {p: 0 if any(weight(p[:k]) == 0 for k in (1, 2, 3)) else t * epochs for p, t in tokens.items()}
    given = {(): min(sum(tokens.values()) * percent // 100, sum(room.values()))}
    for depth in (1, 2, 3):
        groups = defaultdict(dict)
        for p, r in room.items():
            c, w = groups[p[: depth - 1]].get(p[:depth], (0, weight(p[:depth])))
            groups[p[: depth - 1]][p[:depth]] = (c + r, w)
        given |= {n: b for parent, nodes in groups.items() for n, b in share(nodes, given[parent]).items()}
    out = {}
    for p, docs in leaves.items():
        full, rest = divmod(given[p], tokens[p])
        place = {i: int(hashlib.md5(f"{seed}:{full}:{i}".encode()).hexdigest()[:15], 16) for i, _ in docs}
        for i, n in sorted(docs, key=lambda d: place[d[0]]):
            rest -= n
            if full + (rest >= 0):
                out[i] = (*p, n, full + (rest >= 0))
    return out


@pytest.mark.parametrize("percent", [10, 60, 130, 900])
def test_equal_to_brute_force(spark, percent):
    rng = random.Random(percent)
    rows = [
        (i, rng.choice("aabz"), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None]), "w " * rng.choice([1, 3, 9, 40]))
        for i in range(400)
    ]
    # one source that holds a third, one far too small for its weight, and texts without words
    rows += [(1000 + i, "a", "en", "s2", "w " * 20) for i in range(200)] + [(2000, "b", "xx", "s1", "w")]
    rows += [(3000, "a", "en", "s1", None), (3001, "a", "en", "s1", " ")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, domain string, lang string, source string, text string, copies int")
    got = mixing.mix(df, LEVELS, WEIGHTS, percent, buckets=16).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute(rows, percent, 3, 1)
    assert len({r["doc_id"] for r in got}) == len(got)


def test_documents_with_copies_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 9), (2, "c", 9), (None, "d", 9)], "doc_id long, text string, copies int")
    taken = mixing.mix(df, {"source": "'x'"}, {}, 300)
    assert sorted(r["copies"] for r in taken.collect()) == [3, 3, 3]
    rows = mixing.select_documents(df, taken)
    assert rows.columns == df.columns and sorted(r["doc_id"] for r in rows.collect()) == [1, 1, 1, 2, 2, 2]


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b")] * 4, "doc_id long, text string")
    assert mixing.mix(df.limit(0), {"source": "'x'"}, {}, 50).count() == 0
    assert mixing.mix(df, {"source": "'x'"}, {}, 50).count() == 2


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = mixing.mix(df, {"source": "'x'"}, {}, 50)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
