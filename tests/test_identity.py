"""Identity over time, term suggestions and ordered tables on small hand-made inputs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from hazardlens.operators import validity, vocabulary
from hazardlens.plans import result_build
from hazardlens.sinks import writers
from hazardlens.sources import tables

from build import physical as phys
from build import text_frame, values

DAY = validity.DAY


def history(spark, *rows):
    """Rows ``(import, day of July 2026, asset, id)``."""
    out = phys(spark, *[{"assetName": a, "assetId": i} for _, _, a, i in rows])
    stamps = spark.createDataFrame([(n, m, f"2026-07-{d:02d}") for n, (m, d, _, _) in enumerate(rows)], "seq long, import_id string, imported_at string")
    return out.join(stamps, "seq")


def intervals(spark, *rows):
    start = 1782864000  # 1 July 2026, UTC
    got = validity.context_intervals(history(spark, *rows)).select("asset_name", "scr_asset_id", "import_id", "valid_from", "valid_to")
    return [(a, i, m, (f - start) // DAY + 1, None if t is None else (t - start) // DAY + 1) for a, i, m, f, t in values(got)]


def test_intervals_merge_end_and_come_back(spark):
    got = intervals(
        spark,
        ("m1", 1, "a", "x"), ("m2", 5, "a", "x"), ("m3", 9, "a", "y"), ("m3", 9, "b", "k"), ("m4", 12, "b", "k"), ("m5", 20, "a", "y"),
        ("m1", 1, "", "?"),
    )
    # m4 does not have a: it is unknown until m5 has it again
    assert got == [("a", "x", "m1", 1, 9), ("a", "y", "m3", 9, 12), ("a", "y", "m5", 20, None), ("b", "k", "m3", 9, 20)]


def test_of_one_moment_the_last_import_counts_and_a_rerun_changes_nothing(spark):
    once = [("m1", 1, "a", "x"), ("m2", 1, "a", "y"), ("m2", 1, "b", "k"), ("m3", 4, "a", "y")]
    assert intervals(spark, *once) == [("a", "y", "m2", 1, None), ("b", "k", "m2", 1, 4)]
    assert intervals(spark, *once, once[1], once[3]) == intervals(spark, *once)
    assert intervals(spark) == []


@pytest.mark.parametrize("bucket", [1, 7, validity.BUCKET])
def test_as_of_equals_looking_at_every_interval(spark, bucket):
    rng = random.Random(bucket)
    held = []
    for key in "abc":
        edges = sorted(rng.sample(range(100), 6))
        held += [(key, f"{key}{s}", s, e) for s, e in zip(edges, edges[1:]) if rng.random() < 0.7]
        held.append((key, f"{key}open", edges[-1], None))
    asked = [(i, rng.choice("abcd"), rng.choice([None, *range(-5, 130)])) for i in range(200)]
    got = validity.as_of(
        spark.createDataFrame(asked, "i int, asset_name string, moment long"),
        spark.createDataFrame(held, "asset_name string, what string, valid_from long, valid_to long"),
        "moment",
        bucket=bucket,
    )
    want = []
    for i, key, at in asked:
        found = [w for k, w, s, e in held if at is not None and k == key and s <= at and (e is None or at < e)]
        want.append((i, found[0] if found else None))
    assert values(got, "i", "what") == sorted(want, key=lambda r: str(r[0]))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(above + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_suggestions_equal_all_pairs(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(7))) for _ in range(60)]
    known, asked = sorted(set(words[:25]) - {""}), sorted(set(words[25:]) | {"AB", " ab ", "", "Below 2°C", "below 3c"})
    known = [*known, "Below 2C"]
    got = vocabulary.with_suggestions(text_frame(spark, "term", [*asked, None]), text_frame(spark, "term", [*known, "", None]))
    canonical = {"below 2°c": "below 2c"}
    key = lambda t: canonical.get(t.strip().lower(), t.strip().lower())
    for term, suggestion, distance in got.collect():
        best = min(((edits(key(term), key(k)), k) for k in known), default=None) if term and key(term) else None
        want = (None, None) if best is None or best[0] > 2 else (best[1], best[0])
        assert (suggestion, distance) == want, term


def test_ordered_tables_keep_their_order_over_files(spark, tmp_path):
    rows = [(f"a{n % 7}", s, h, float(n % 5)) for n, (s, h) in enumerate(itertools.product("st", range(2000, 2150)))]
    table = spark.createDataFrame(rows, "asset_name string, scenario string, horizon int, x double").repartition(9)
    writers.write_ordered(table, str(tmp_path / "t"), result_build.report_order(table, "physical_trends"))
    want = sorted(rows, key=lambda r: r[:3])
    for first, n in ((1, None), (1, 10), (95, 20), (299, 50), (400, 5)):
        page = tables.read_page(spark, str(tmp_path / "t"), first, n)
        got = [tuple(r)[:4] for r in page.orderBy("position").collect()]
        assert got == want[first - 1 : None if n is None else first - 1 + n]
    stretches = spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).agg(F.min("position"), F.max("position"), F.count("*"))
    spans = sorted(tuple(r)[1:] for r in stretches.collect())
    assert all(high - low + 1 == n for low, high, n in spans) and [s[0] for s in spans[1:]] == [s[1] + 1 for s in spans[:-1]]
