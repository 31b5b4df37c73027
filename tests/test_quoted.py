"""CSV with line breaks in values, read in small blocks, against the csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from hazardlens.sources import quoted, tables

from build import values


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_state_after_a_line():
    cases = [
        ("", False, False), ("", True, True), ('a,"b', False, True), ('a,"b"', False, False), ('b",c', True, False),
        ('b",c,"', True, True), ('5" pipe,x', False, False), ('"a""', False, True), ('"a"""', False, False), ('""', True, True),
        ('x""y', True, True), ('"a"b,"c', False, True), ('"', False, True), ('"', True, False), (',,"",', False, False),
    ]
    assert [quoted.after_line(line, inside) for line, inside, _ in cases] == [want for *_, want in cases]


def written(path, rows, end):
    with open(path, "w", newline="") as out:
        csv.writer(out, lineterminator=end).writerows(rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_blocks_equal_one_reading(spark, tmp_path, small_blocks, end):
    rng = random.Random(len(end))
    parts = ["a", '"', ",", "\n", "é", "b c", '""', "x" * 90, "\n\n", '",', '\n"']
    folder = tmp_path / "files"
    folder.mkdir()
    want = {}
    for name in "pq":
        rows = [[str(i), *("".join(rng.choice(parts) for _ in range(rng.randrange(5))) or "-" for _ in range(2))] for i in range(200)]
        written(folder / f"{name}.csv", [["n", "first", "second"], *rows], end)
        want[name] = rows
    df = quoted.read_csv(spark, str(folder))
    assert quoted.records(spark, str(folder)).rdd.getNumPartitions() > 5
    for name, rows in want.items():
        got = df.where(F.col("source_file").endswith(f"{name}.csv")).orderBy("seq").collect()
        assert [[r["n"], r["first"], r["second"]] for r in got] == rows
    assert df.select("source_file", "seq").distinct().count() == 400


def test_manifest_with_breaks_by_several_tasks(spark, tmp_path, small_blocks):
    rows = [[f"n{i}", f"u{i}", f"Street {i}\nTown, \"{i}\"" * (i % 4)] for i in range(100)]
    written(tmp_path / "m.csv", [["scr_asset_name", "plant_uuid", "address"], *rows, ["n5", "last", ""]], "\n")
    got = values(tables.read_manifest(spark, str(tmp_path / "m.csv")), "scr_asset_name", "manifest.plant_uuid", "manifest.address")
    want = [(n, "last" if n == "n5" else u, None if n == "n5" else a or None) for n, u, a in rows]
    assert got == sorted(want)
    one_task = spark.read.csv(str(tmp_path / "m.csv"), header=True, multiLine=True, quote='"', escape='"')
    assert {r[0] for r in one_task.select("address").collect()} - {None, rows[5][2]} == {a for _, _, a in got} - {None}


def test_odd_files(spark, tmp_path):
    folder = tmp_path / "odd"
    folder.mkdir()
    (folder / "a.csv").write_bytes("﻿a,b\r\n\r\n1,\r\n , \n2,\"x\"\"\ny\"".encode())
    (folder / "b.csv").write_text("a,b\n")
    (folder / "c.csv").write_text("")
    got = quoted.read_csv(spark, str(folder))
    assert values(got, "a", "b") == [("1", None), ("2", 'x"\ny'), (" ", " ")] or values(got, "a", "b") == [(" ", " "), ("1", None), ("2", 'x"\ny')]
    (folder / "d.csv").write_text("a,c\n1,2\n")
    with pytest.raises(Exception, match="another header in"):
        quoted.read_csv(spark, str(folder)).collect()
    (folder / "d.csv").write_text('a,b\n1,"2\n3,4\n')
    with pytest.raises(Exception, match="a quoted value is not closed in"):
        quoted.read_csv(spark, str(folder)).collect()


def test_the_reader_of_each_row_is_the_csv_modules(spark, tmp_path):
    text = 'k,v\n1,5" pipe\n2,"a, ""b"""\n3,a"b"c\n4,\n'
    (tmp_path / "f.csv").write_text(text)
    want = [tuple(r) for r in csv.reader(io.StringIO(text))][1:]
    got = [(r["k"], r["v"] or "") for r in quoted.read_csv(spark, str(tmp_path / "f.csv")).orderBy("seq").collect()]
    assert got == want
