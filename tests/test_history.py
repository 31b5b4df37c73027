"""Commits of the import history: whole or not at all, in order, readable as of any of them."""

import tracemalloc
import zipfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from hazardlens.operators.quality import ImportFailure
from hazardlens.plans import import_run, result_build
from hazardlens.schemas import PHYSICAL_REQUIRED
from hazardlens.sinks import writers
from hazardlens.sinks.history import History
from hazardlens.sources import tables, workbooks

from build import sheet, values, workbook
from test_files import HEADER, RETURNED, manifest_for, output, put

NAME = "is_p_" + "e" * 32


def rows_of(spark, *numbers):
    return spark.createDataFrame([(n, f"v{n}", "2026") for n in numbers], "n long, v string, imported_at string")


def test_as_of_and_schema_changes(spark, tmp_path):
    history = History(spark, str(tmp_path))
    assert history.version() is None and history.entries().count() == 0
    with pytest.raises(ValueError, match="no table"):
        history.read("rows")
    assert history.append("i1", rows=rows_of(spark, 1, 2), notes=rows_of(spark)) == 0
    assert history.append("i2", rows=rows_of(spark, 3).withColumn("more", F.lit(1))) == 1
    assert values(history.read("rows", 0), "n") == [(1,), (2,)] and history.read("rows", 0).columns == ["n", "v", "imported_at", "import_id"]
    assert values(history.read("rows"), "import_id", "n", "more") == [("i1", 1, None), ("i1", 2, None), ("i2", 3, 1)]
    assert history.read("notes").count() == 0 and history.read("notes").columns[-1] == "import_id"
    with pytest.raises(ValueError, match="commits 0 to 1"):
        history.read("rows", 2)


def test_a_repeated_import_adds_nothing_and_a_changed_one_is_refused(spark, tmp_path):
    history = History(spark, str(tmp_path))
    history.append("i1", rows=rows_of(spark, 1, 2))
    again = rows_of(spark, 2, 1).withColumn("imported_at", F.lit("2027")).repartition(3)
    assert history.append("i1", rows=again) is None
    with pytest.raises(ImportFailure, match="i1 is in"):
        history.append("i1", rows=rows_of(spark, 1, 3))
    # a table that the import did not have yet is added
    assert history.append("i1", rows=rows_of(spark, 1, 2), notes=rows_of(spark, 9)) == 1
    assert history.read("rows").count() == 2 and values(history.read("notes"), "n") == [(9,)]
    # nothing is left of what was not committed
    assert len(list((tmp_path / "data" / "rows").iterdir())) == 1


def test_a_write_that_dies_half_way_changes_nothing(spark, tmp_path):
    history = History(spark, str(tmp_path))
    history.append("i1", rows=rows_of(spark, 1))

    def dying(batches):
        for batch in batches:
            yield batch.slice(0, 1)
            raise RuntimeError("executor lost")

    rows = rows_of(spark, *range(1000)).coalesce(1)
    pending = history.begin()
    pending.write("rows", rows, "i2")
    with pytest.raises(Exception, match="executor lost"):
        pending.write("notes", rows.mapInArrow(dying, rows.schema), "i2")
    # the driver is gone: nobody tidies up, the first table lies there whole and the second in part
    assert len(list((tmp_path / "data" / "rows").iterdir())) == 2
    assert History(spark, str(tmp_path)).version() == 0
    assert values(history.read("rows"), "n") == [(1,)]
    assert history.append("i2", rows=rows, notes=rows) == 1
    assert history.read("rows").count() == 1001 and history.read("notes").count() == 1000


def test_writers_at_once_all_get_a_number(spark, tmp_path):
    history = History(spark, str(tmp_path))
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: History(spark, str(tmp_path)).append(f"i{i}", rows=rows_of(spark, i)), range(6)))
    assert sorted(numbers) == list(range(6))
    assert values(history.read("rows"), "n") == [(i,) for i in range(6)]
    # of two that bring one import with different rows only the first gets through
    one, two = history.begin(), history.begin()
    one.write("rows", rows_of(spark, 100), "same")
    two.write("rows", rows_of(spark, 101), "same")
    assert one.publish() == 6
    with pytest.raises(ImportFailure, match="same is in"):
        two.publish()


def counted(spark, tmp_path, folder):
    """The workbook files of a folder, and a function that tells how often each went to the decoder."""
    log = tmp_path / "seen"
    log.mkdir()
    place = str(log)

    def count(batches):
        import uuid

        for batch in batches:
            for name in batch.column("path").to_pylist():
                with open(f"{place}/{uuid.uuid4().hex}", "w") as out:
                    out.write(name)
            yield batch

    files = workbooks._files(spark, str(folder)).mapInArrow(count, "path string, content binary")
    return files, lambda: sorted(f.read_text().split("/")[-1] for f in log.iterdir())


def test_an_import_decodes_each_file_once(spark, tmp_path):
    folder = tmp_path / "returns"
    for n in range(3):
        put(folder, f"{n}.xlsx", output(HEADER, [NAME, "s", 2025 + n, "Flood", 1.0 if n else None]))
    files, seen = counted(spark, tmp_path, folder)
    terms = spark.createDataFrame([("FLOOD",), ("HEAT",)], "term string")
    args = (manifest_for(spark, NAME), "physical", "i1", "2026-07-01", str(tmp_path / "h"), {"hazard": terms}, ["indicatorValue"])
    counts = import_run.import_returns(workbooks.decode_returns(files, "physical"), *args)
    assert seen() == ["0.xlsx", "1.xlsx", "2.xlsx"]
    assert counts == {"rows": 3, "blank_names": 0, "blank_metrics": 1, "unusable_files": 0, "warnings": 2, "version": 0}
    history = History(spark, str(tmp_path / "h"))
    assert "_corrupt" not in history.read("physical_long").columns
    assert values(history.read("import_warnings"), "code", "n") == [("hazard_not_returned", 1), ("metrics_blank", 1)]


def test_unusable_files_stop_an_import_and_are_listed(spark, tmp_path):
    folder = tmp_path / "returns"
    put(folder, "good.xlsx", output(HEADER, [NAME, "s", 2025, "Flood", 1.0]))
    put(folder, "junk.xlsx", b"junk")
    broken = workbook({"Output": sheet([HEADER, *[[NAME, "s", 2025, "Flood", 1.0]] * 9000]) + "<row><c></row>"})
    put(folder, "torn.xlsx", broken)
    rows = workbooks.decode_returns(workbooks._files(spark, str(folder)), "physical")
    args = (manifest_for(spark, NAME), "physical", "i1", "2026-07-01", str(tmp_path / "h"), {}, ["indicatorValue"])
    with pytest.raises(ImportFailure, match="2 x unreadable_file"):
        import_run.import_returns(rows, *args)
    assert History(spark, str(tmp_path / "h")).version() is None
    listed = spark.read.parquet(str(tmp_path / "h" / "import_failures" / "i1"))
    assert [f.split("/")[-1] for f, _, _ in values(listed)] == ["junk.xlsx", "torn.xlsx"]
    assert not list((tmp_path / "h" / "data" / "physical_long").iterdir())


def test_a_long_workbook_is_decoded_in_bounded_memory(tmp_path):
    """A million rows take no more memory than some thousands do."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"

    def book(n):
        path = tmp_path / f"{n}.xlsx"
        path.write_bytes(workbook({"Output": sheet([PHYSICAL_REQUIRED])}))
        with zipfile.ZipFile(path) as old, zipfile.ZipFile(tmp_path / "new.xlsx", "w", zipfile.ZIP_DEFLATED) as new:
            for item in old.namelist():
                if "worksheets" not in item:
                    new.writestr(item, old.read(item))
            with new.open("xl/worksheets/s1.xml", "w") as out:
                out.write(f'<worksheet xmlns="{main}"><sheetData>{sheet([PHYSICAL_REQUIRED])}'.encode())
                some = b"".join(b'<row><c r="A1"><v>%d</v></c><c r="C1"><v>2025</v></c></row>' % i for i in range(1000))
                for _ in range(n // 1000):
                    out.write(some)
                out.write(b"</sheetData></worksheet>")
        return (tmp_path / "new.xlsx").read_bytes()

    decode, _ = workbooks.returns_decoder("physical")

    def peak(content):
        class Files:
            def column(self, name):
                import pyarrow as pa

                return pa.array(["p"]) if name == "path" else pa.array([content], pa.binary())

        tracemalloc.start()
        n, last = 0, None
        for batch in decode([Files()]):
            assert batch.num_rows <= workbooks.BATCH_ROWS
            n, last = n + batch.num_rows, batch.column("seq")[batch.num_rows - 1].as_py()
        assert last == n - 1
        high = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return n, high

    small, large = peak(book(8_000)), peak(book(1_000_000))
    assert (small[0], large[0]) == (8_000, 1_000_000)
    assert large[1] < 1.5 * small[1] + 20_000_000


def test_a_result_set_decodes_each_file_once(spark, tmp_path):
    for n in range(2):
        put(tmp_path / "p", f"p{n}.xlsx", output(HEADER, [NAME, "s", 2025 + n, "Flood", 1.0]))
        row = {"assetName": NAME, "scenario": "s", "subrisk": "X", "timeHorizon": 2030, "adjustedSubriskRevenueImpact": 2.0}
        put(tmp_path / "t", f"t{n}.xlsx", output(RETURNED, [row.get(c) for c in RETURNED]))
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    phys_files, phys_seen = counted(spark, tmp_path / "a", tmp_path / "p")
    trans_files, trans_seen = counted(spark, tmp_path / "b", tmp_path / "t")
    order = ("source_file", "seq")
    phys, trans = (workbooks.readable(workbooks.decode_returns(f, k)) for f, k in ((phys_files, "physical"), (trans_files, "transition")))
    writers.write_results(result_build.build_results(phys, trans, manifest_for(spark, NAME), order), str(tmp_path / "res"))
    assert (phys_seen(), trans_seen()) == (["p0.xlsx", "p1.xlsx"], ["t0.xlsx", "t1.xlsx"])
    assert values(tables.read_results(spark, str(tmp_path / "res")).trends, "horizon") == [(2025,), (2026,)]
