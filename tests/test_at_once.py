"""Writes that do not wait for each other run at the same time, from rows that are computed once."""

import threading

import pytest
from pyspark.sql import functions as F

from hazardlens.operators import joins
from hazardlens.plans import incremental, queries, result_build
from hazardlens.sinks import clustered, history, writers

from build import physical as phys
from build import transition as trans

SF = "/root/testdata/sf0.001"


def meeting(function, parties):
    """The function, whose callers wait until so many of them are there."""
    barrier = threading.Barrier(parties)

    def met(*args, **options):
        barrier.wait(60)
        return function(*args, **options)

    return met


def test_jobs_meet_and_keep_their_order(spark):
    both = meeting(lambda n: spark.range(n).count(), 2)
    assert joins.at_once(spark, [lambda: both(3), lambda: both(5)]) == [3, 5]
    with pytest.raises(ZeroDivisionError):
        joins.at_once(spark, [lambda: 1 // 0, lambda: 1])


def test_all_tables_of_all_imports_are_written_at_the_same_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history.Pending, "write", meeting(history.Pending.write, 16))
    grown = history.History(spark, str(tmp_path))
    both = [(f"i{n}", "2026", phys(spark, {}), trans(spark, {})) for n in range(2)]
    assert incremental.add_imports(grown, both) == [0, 1]
    names = [r["table"] for r in grown.entries(0).collect()]
    assert names[0] == "state_trends" and names[-1] == "state_assets" and len(names) == 8


def test_a_failed_import_leaves_no_files_of_any(spark, tmp_path):
    grown = history.History(spark, str(tmp_path))
    bad = phys(spark, {}).withColumn("indicator", F.raise_error(F.lit("broken row")))
    with pytest.raises(Exception, match="broken row"):
        incremental.add_imports(grown, [("a", "2026", phys(spark, {}), trans(spark, {})), ("b", "2026", bad, trans(spark, {}))])
    assert grown.version() is None and not list(tmp_path.rglob("*.parquet"))


def test_thirds_are_plain_ranges_of_the_key_that_cover_the_table(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(incremental, "add_imports", lambda _, imports: seen.extend(imports))
    monkeypatch.setattr(incremental, "results", lambda *_: None)
    queries._grown(spark, SF)
    for place, table, key in ((2, "events", "event_id"), (3, "orders", "o_orderkey")):
        whole = spark.read.parquet(f"{SF}/{table}.parquet")
        last = whole.agg(F.max(key)).first()[0]
        for import_id, *_ in seen:
            n = int(import_id[-1])
            third = next(i for i in seen if i[0] == import_id)[place]
            want = whole.where(F.floor(F.col(key) * 3 / (last + 1)) == n)
            assert sorted(r[0] for r in third.select("seq").collect()) == sorted(r[0] for r in want.select(key).collect())
            assert f"GreaterThanOrEqual({key}" in third._jdf.queryExecution().executedPlan().toString()


def small_results(spark):
    return result_build.build_results(phys(spark, {}), trans(spark, {}))


def test_result_tables_are_written_at_the_same_time(spark, tmp_path, monkeypatch):
    res = small_results(spark)
    writer = type(res.trends.write)
    monkeypatch.setattr(writer, "save", meeting(writer.save, 7))
    writers.write_results(res, str(tmp_path))


def test_both_inputs_of_a_build_are_staged_at_the_same_time(spark, monkeypatch):
    monkeypatch.setattr(joins, "staged", meeting(joins.staged, 2))
    small_results(spark)


def test_clustered_tables_are_written_at_the_same_time(spark, tmp_path, monkeypatch):
    res = small_results(spark)
    monkeypatch.setattr(clustered, "write_clustered", meeting(clustered.write_clustered, 7))
    writers.write_clustered_results(res, str(tmp_path))


def test_slices_are_written_from_rows_that_are_computed_once(spark, monkeypatch):
    seen = []

    def write(res, path, file_rows):
        seen.extend(file for name in res.__dataclass_fields__ for file in getattr(res, name).inputFiles())

    monkeypatch.setattr(writers, "write_clustered_results", write)
    monkeypatch.setattr(queries.tables, "read_results_slice", lambda *_: queries.reports.Results(*[None] * 7))
    queries.slice_from_files(spark, SF)
    assert seen and all("/staged/" in file for file in seen)
