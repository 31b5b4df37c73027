"""URL filter and top-k search against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import types as T

from hazardlens.llm import topk, urls
from hazardlens.llm.queries import RULES as QUERY_RULES

RULES = (
    urls.Rule("org/", "allow"),
    urls.Rule("example.org/es/", "block"),
    urls.Rule("example.org/en/1", "allow"),
    urls.Rule("com/de/", "block"),
)


def judge(spark, addresses, **options):
    rows = [(i, u, "kept") for i, u in enumerate(addresses)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    return {r["page_id"]: r for r in urls.judge_urls(df, rules=RULES, **options).collect()}


def test_parts_and_rules(spark):
    addresses = [
        "HTTPS://Sub.Example.ORG/es/1?x#y",
        "https://example.org/en/12",
        "https://example.org",
        "http://notexample.org.com/de/1",
        "http://mycom/de/1",
        "no scheme/casino",
        None,
        "",
        "x://a.com?casino",
    ]
    got = judge(spark, addresses)
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(len(addresses))] == [
        ("sub.example.org", "/es/1", "example.org/es/", "block"),
        ("example.org", "/en/12", "example.org/en/1", "allow"),
        ("example.org", "", None, "allow"),
        ("notexample.org.com", "/de/1", "com/de/", "block"),
        ("mycom", "/de/1", None, "allow"),
        ("", "", None, "block"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("a.com", "", None, "block"),
    ]


def test_registered_rules_are_those_of_the_contract(spark):
    assert [(r.pattern, r.verdict) for r in QUERY_RULES] == [
        ("org/", "allow"),
        ("example.org/es/", "block"),
        ("example.org/en/1", "block"),
        ("com/fr/", "allow"),
        ("com/de/", "block"),
    ]
    rows = [(0, "https://sub.example.org/en/12"), (1, "https://example.org/en/2")]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules=QUERY_RULES).collect()
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in got} == {0: ("example.org/en/1", "block"), 1: ("org/", "allow")}


def test_boundaries_and_distinct_soft_terms(spark):
    got = judge(
        spark,
        [
            "http://x.net/casinos",
            "http://x.net/CASINO-1",
            "http://x.net/free",
            "http://x.net/free-free-free",
            "http://x.net/free_cheap",
            "http://x.net/freecheap",
            "http://x.net/" + "a" * 200_000 + "/xxx",
        ],
    )
    assert [got[i]["verdict"] for i in range(7)] == ["allow", "block", "allow", "allow", "block", "allow", "block"]
    assert got[3]["soft_terms"] == 1 and got[4]["soft_terms"] == 2


def test_hits_equal_brute_force():
    rng = random.Random(4)
    vocabulary = urls.Vocabulary((("ab", 1.0), ("b", 1.0)), (("a", 0.5), ("abba", 0.5), ("ba", 0.5)))

    def brute(text, terms):
        edge = [c not in "abc" for c in text]
        return sum(
            any(
                text[i : i + len(t)] == t and (i == 0 or edge[i - 1]) and (i + len(t) == len(text) or edge[i + len(t)])
                for i in range(len(text))
            )
            for t, _ in terms
        )

    for _ in range(500):
        text = "".join(rng.choice("abc-/") for _ in range(rng.randint(0, 20)))
        strict, _, soft, _ = urls.term_hits(text, vocabulary)
        assert (strict, soft) == (brute(text, vocabulary.strict), brute(text, vocabulary.soft))


def test_empty_vocabulary_and_table(spark):
    none = urls.Vocabulary((), ())
    assert judge(spark, ["http://x.net/casino"], vocabulary=none)[0]["verdict"] == "allow"
    assert judge(spark, []) == {}


def brute_top(rows, query_ids, k):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        w = tuple(int(np.floor(256 * float(x))) for x in v)
        vectors[i] = min(vectors.get(i, w), w)
    out = set()
    for q in query_ids:
        if q in vectors:
            scored = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("rank", T.StringType())])


@pytest.mark.parametrize("block", [3, 16, 4096])
def test_top_k_equals_brute_force(spark, block):
    rng = np.random.default_rng(block)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.02, 6)]) for i in range(60)]
    rows += [(100, None), (101, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (102, [float("nan")] * 6), (103, [float("inf")] * 6), (None, [0.0] * 6)]
    rows += [(104, [0.0] * 6), rows[0], (1, [0.5] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows], VECTORS)
    got = topk.top_k(df.where("vec_id % 5 = 0 or vec_id = 104"), df, k=5, block=block).collect()
    ids = [i for i, _ in rows if i is not None and (i % 5 == 0 or i == 104)]
    assert {tuple(r) for r in got} == brute_top(rows, ids, 5)


def test_few_and_no_candidates(spark):
    df = spark.createDataFrame([(1, [1.0], ""), (2, [1.0], "")], VECTORS)
    assert [tuple(r) for r in topk.top_k(df.where("vec_id = 1"), df).collect()] == [(1, 1, 2, 65536)]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_large_components_stay_exact(spark):
    big = float(2**23)
    df = spark.createDataFrame([(1, [big, 1.0], ""), (2, [big, 1.0], ""), (3, [big, 0.99609375], "")], VECTORS)
    got = [tuple(r)[2:] for r in topk.top_k(df.where("vec_id = 1"), df).orderBy("rank").collect()]
    assert got == [(2, 2**62 + 65536), (3, 2**62 + 256 * 255)]


def test_search_stops_early():
    x = np.zeros((1000, 2))
    x[:, 0] = np.arange(1000)
    ids = np.arange(1000)
    seen = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.ndim == 1:
                seen.append(len(key))
            return super().__getitem__(key)

    found, score = topk.threshold_search(x.view(Counted), ids, np.argsort(x, axis=0, kind="stable"), np.array([1.0, 0.0]), -1, 3)
    assert found.tolist() == [999, 998, 997] and sum(seen) < 100
