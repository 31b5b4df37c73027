"""Sidecar lookup per plant against one that tries every key of every asset."""

import random

import pytest
from pyspark.sql import functions as F

from hazardlens.operators import sidecar
from hazardlens.plans import queries

from build import sidecar as side_rows, values

NAMED = "plant_uuid string, scr_asset_name string, portfolio_asset_id string, eia_plant_id int, id long"
SF = "/root/testdata/sf0.001"


def some_assets(rng):
    """Assets of few plants, with keys missing and keys that look like those of another kind."""
    plants = [(rng.choice([None, f"u{n}"]), rng.choice([None, f"n{n}", "m3"]), rng.choice([None, n % 4])) for n in range(12)]
    rows = []
    for n in range(80):
        uuid, name, eia = rng.choice(plants)
        rows.append((uuid, name, rng.choice([None, f"m{n % 20}", "u5"]), eia, n))
    return rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("with_plants", [False, True])
def test_lookup_equals_trying_every_key(spark, seed, with_plants):
    rng = random.Random(seed)
    rows = some_assets(rng)
    keys = [f"u{n}" for n in range(12)] + [f"n{n}" for n in range(12)] + [f"m{n}" for n in range(20)] + ["0", "1", "2"]
    known = {k: str(i) for i, k in enumerate(rng.sample(keys, 24))}
    index = sidecar.index_sidecar(side_rows(spark, *({"plant_uuid": k, "asset_value": value} for k, value in known.items())))
    assets = spark.createDataFrame(rows, NAMED)
    # twice and with a plant that no asset has
    plants = assets.unionByName(spark.createDataFrame([("u0", "n1", None, 2, -1)], NAMED)) if with_plants else None
    want = []
    for uuid, name, membership, eia, n in rows:
        tried = [uuid, name, membership, None if eia is None else str(eia)]
        want.append((n, next((known[k] for k in tried if k in known), None)))
    got = sidecar.resolve_sidecar(assets, index, plants)
    assert got.columns == [*assets.columns, "side"]
    assert dict(values(got, "id", "side.asset_value")) == dict(want) and got.count() == len(rows)


def test_assets_are_read_once_when_their_plants_are_given(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(name):
        seen.add(1)
        return name

    plants = spark.createDataFrame([("u1", "n1", None, 1, 0)], NAMED)
    assets = spark.range(40).select(
        counted(F.lit("u1")).alias("plant_uuid"), F.lit("n1").alias("scr_asset_name"),
        F.format_string("m%d", "id").alias("portfolio_asset_id"), F.lit(1).alias("eia_plant_id"), "id",
    )
    index = sidecar.index_sidecar(side_rows(spark, {"scr_asset_name": "n1", "asset_value": "7"}))
    found = sidecar.resolve_sidecar(assets, index, plants).select("id", "side.asset_value", "plant_uuid")
    assert {r["asset_value"] for r in found.collect()} == {"7"} and seen.value == 40


@pytest.mark.parametrize("name", ["manifest_rows", "upload_values"])
def test_an_export_joins_its_memberships_once(spark, name):
    """The lookup needs the plants; it does not build the scope a second time."""
    text = queries.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    # the kind and name of a portfolio come with the scope alone
    assert text.count("n_nationkey#") and sum("Relation [n_nationkey" in line for line in text.splitlines()) == 1
