"""Tables along a curve: a slice equals the filter, and opens few files."""

import random

import pytest
from pyspark.sql import functions as F

from hazardlens.sinks import clustered

KEYS = ["scenario", "horizon", "asset_name"]


@pytest.fixture(scope="module")
def laid(spark, tmp_path_factory):
    """24,000 rows of 400 assets, 10 horizons and 3 scenarios in 48 files."""
    path = str(tmp_path_factory.mktemp("laid") / "t")
    rows = spark.range(24_000).select(
        "id",
        F.format_string("s%d", F.col("id") % 3).alias("scenario"),
        (2010 + F.floor(F.col("id") / 3) % 10 * 10).cast("int").alias("horizon"),
        F.format_string("a%03d", F.floor(F.col("id") / 30) % 400).alias("asset_name"),
    )
    clustered.write_clustered(rows, path, KEYS, file_rows=500)
    return rows, path


def ids(table):
    return sorted(r["id"] for r in table.select("id").collect())


def test_all_rows_are_there_once_and_the_index_counts_them(spark, laid):
    rows, path = laid
    assert ids(clustered.read_slice(spark, path, {})) == list(range(24_000))
    index = spark.read.parquet(f"{path}/files")
    assert index.count() > 40 and index.agg(F.sum("rows")).first()[0] == 24_000
    assert clustered.indexed_columns(spark, path) == KEYS


@pytest.mark.parametrize(
    ("wanted", "condition", "most"),
    [
        ({"asset_name": "a123", "horizon": 2050}, "asset_name = 'a123' AND horizon = 2050", 12),
        ({"asset_name": "a123", "horizon": 2050, "scenario": "s2"}, "asset_name = 'a123' AND horizon = 2050 AND scenario = 's2'", 4),
        ({"scenario": "s1", "horizon": 2100}, "scenario = 's1' AND horizon = 2100", 12),
        ({"horizon": (2030, 2040)}, "horizon BETWEEN 2030 AND 2040", 30),
        ({"asset_name": (None, "a010")}, "asset_name <= 'a010'", 24),
        ({"scenario": "none"}, "scenario = 'none'", 0),
        ({"asset_name": "a000", "id": (5, 9)}, "asset_name = 'a000' AND id BETWEEN 5 AND 9", 24),
    ],
)
def test_a_slice_equals_the_filter_and_opens_few_files(spark, laid, wanted, condition, most):
    rows, path = laid
    got = clustered.read_slice(spark, path, wanted)
    assert ids(got) == ids(rows.where(condition))
    assert clustered.files_of_slice(spark, path, wanted).count() <= most
    if most:
        assert len(got.inputFiles()) <= most


def test_a_hot_value_nulls_and_repeated_rows(spark, tmp_path):
    rng = random.Random(3)
    data = [(i % 700, rng.choice(["hot", "hot", None, "a", "b"]), rng.choice([None, 1, 2, 3]), "x") for i in range(3000)]
    rows = spark.createDataFrame(data, "id int, asset_name string, horizon int, _rest string")
    path = str(tmp_path / "t")
    clustered.write_clustered(rows, path, ["asset_name", "horizon"], file_rows=100)
    for wanted, condition in [({"asset_name": "hot"}, "asset_name = 'hot'"), ({"horizon": (2, None)}, "horizon >= 2"), ({}, "true")]:
        assert ids(clustered.read_slice(spark, path, wanted)) == ids(rows.where(condition))
    # no file takes a hot value whole
    assert spark.read.parquet(f"{path}/files").agg(F.max("rows")).first()[0] < 400
    assert clustered.read_slice(spark, path, {}).columns == rows.columns


def test_an_empty_table(spark, tmp_path):
    rows = spark.createDataFrame([], "id int, asset_name string")
    clustered.write_clustered(rows, str(tmp_path / "t"), ["asset_name"])
    got = clustered.read_slice(spark, str(tmp_path / "t"), {"asset_name": "a"})
    assert got.columns == rows.columns and got.count() == 0


def test_the_curve_takes_bits_in_turn(spark):
    row = spark.range(1).select(clustered.curve_place([F.lit(0b101).cast("bigint"), F.lit(0b011).cast("bigint")], 3).alias("p"))
    assert row.first()["p"] == 0b100111
