from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hazardlens.functions.numbers import decimal_text
from hazardlens.functions.text import pipe_join
from hazardlens.operators import assets, export, registry, runs, sidecar
from hazardlens.operators.registry import Registry

from build import column, sidecar as side_rows, values

U = {n: f"0000000{n}-0000-0000-0000-000000000000" for n in range(1, 7)}


@pytest.fixture(scope="module")
def reg(spark):
    plants = [
        (U[1], 11, "plant-1", "eia", None, '{"plant_name":"","name":"One","lat":"47.5","lon":"-121.25","total_capacity_mw":"103.9"}'),
        (U[2], None, "plant-2", "user_added", "w1", '{"plant_name":"Two","primary_fuel":"NG"}'),
        (U[3], 13, "plant-3", "eia", "gone", "{}"),
    ]
    index = [
        (11, "Index one", None, "Owner", "Parent", "WA", "Pierce", 1.5, 2.5, "WAT", ["WAT", None], ["Conventional Hydroelectric"], 7.0),
        (13, "", "Utility", None, None, "WA", "Lake County", None, None, "WND", ["SUN", "WND"], None, None),
    ]
    memberships = [
        ("m1", "w1", "p1", U[1], True, None),
        ("m2", "w1", "p2", U[1], False, None),
        ("m3", "w1", "p1", U[2], True, "2026"),
        ("m4", "w1", "dead", U[3], True, None),
        ("m5", "dead", "p1", U[3], True, None),
    ]
    return Registry(
        spark.createDataFrame(plants, "id string, eia_plant_id int, slug string, source_type string, workspace_id string, data string"),
        spark.createDataFrame(
            index,
            "plant_id int, plant_name string, utility_eia_name string, canonical_owner string, gem_parent_name string, state string,"
            "county string, lat double, lon double, primary_fuel string, fuel_types array<string>, technologies array<string>, total_capacity_mw double",
        ),
        spark.createDataFrame([(U[1], "2367.974609")], "plant_id string, latest_capex_per_kw string"),
        spark.createDataFrame([("w1", "demo", None), ("dead", "old", "2026")], "id string, slug string, deleted_at string"),
        spark.createDataFrame([("w1", U[1], "portfolio"), ("w1", U[2], "prospect"), ("dead", U[3], "portfolio")], "workspace_id string, plant_id string, state string"),
        spark.createDataFrame(
            [
                ("p1", "w1", "Alpha", "client", "2026-01-01", None),
                ("p2", "w1", "Beta", "client", "2026-01-02", None),
                ("p3", "w1", "Beta", "client", "2026-01-03", None),
                ("dead", "w1", "Dead", "client", "2026-01-04", "2026"),
            ],
            "id string, workspace_id string, name string, kind string, created_at string, deleted_at string",
        ),
        spark.createDataFrame(memberships, "id string, workspace_id string, portfolio_id string, reference_plant_id string, is_baseline boolean, deleted_at string"),
    )


def test_json_wins_over_index_and_blank_json_does_not(reg):
    row = registry.scope_reference(reg).collect()[0]
    assert (row["plant_name"], row["state"], row["operating_entity_name"]) == ("One", "WA", "Owner")
    assert (row["latitude"], row["fuel_types"], row["latest_capex_per_kw"]) == (Decimal("47.5"), ["WAT"], Decimal("2367.974609"))
    assert row["workspace_id"] is None and row["portfolio_asset_id"] is None


def test_plant_scope_fans_out_and_keeps_rows_of_deleted_portfolios(reg):
    got = values(registry.scope_plants(reg, list(U.values())), "plant_uuid", "workspace_id", "portfolio_id", "portfolio_asset_id")
    assert got == [
        (U[1], None, "p1", "m1"),
        (U[1], None, "p2", "m2"),
        (U[2], "w1", None, None),
        (U[3], None, "p1", "m5"),
        (U[3], None, None, "m4"),
    ]


def test_portfolio_scope_needs_everything_live(reg):
    assert values(registry.scope_portfolio(reg, "p1"), "plant_uuid", "portfolio_asset_id") == [(U[1], "m1")]
    assert values(registry.scope_portfolio(reg, "dead"), "plant_uuid") == []


def test_workspace_scope_by_state_with_baseline(reg):
    both = registry.scope_workspace(reg, "w1", "all")
    assert values(both, "plant_uuid", "portfolio_id", "workspace_asset_state") == [(U[1], "p1", "portfolio"), (U[2], None, "prospect")]
    assert values(registry.scope_workspace(reg, "w1"), "plant_uuid") == [(U[1],)]
    assert registry.scope_workspace(reg, "dead", "all").count() == 0


def test_names_to_ids(reg):
    assert registry.resolve_workspace(reg.workspace, "demo") == "w1"
    assert registry.resolve_portfolio(reg.portfolio, "w1", "Alpha") == "p1"
    assert column(registry.list_portfolios(reg.portfolio, "w1"), "id") == ["p3", "p2", "p1"]
    for call in (
        lambda: registry.resolve_workspace(reg.workspace, "old"),
        lambda: registry.resolve_portfolio(reg.portfolio, "w1", "Beta"),
        lambda: registry.resolve_portfolio(reg.portfolio, "w1", "Dead"),
    ):
        with pytest.raises(LookupError):
            call()


# -- sidecar -------------------------------------------------------------------------


def named_assets(spark, *rows):
    return spark.createDataFrame(rows, "plant_uuid string, scr_asset_name string, portfolio_asset_id string, eia_plant_id int")


def test_sidecar_priority_and_overwrite(spark):
    side = side_rows(
        spark,
        {"eia_plant_id": "7", "asset_value": "by id"},
        {"plant_uuid": "u1", "asset_value": "by uuid"},
        {"portfolio_asset_id": "m2", "asset_value": "old"},
        {"portfolio_asset_id": "m2", "scr_asset_name": "n9", "asset_value": "new"},
        {"plant_uuid": "7", "asset_value": "shared namespace"},
    )
    found = named_assets(spark, ("u1", "n1", None, 7), ("u2", "n2", "m2", None), ("u3", "n3", None, 7), ("u4", "n4", None, None), ("u5", "n9", None, None))
    got = sidecar.resolve_sidecar(found, sidecar.index_sidecar(side))
    assert values(got, "plant_uuid", "side.asset_value") == [
        ("u1", "by uuid"), ("u2", "new"), ("u3", "shared namespace"), ("u4", None), ("u5", "new"),
    ]


# -- asset types ---------------------------------------------------------------------

CASES = [
    ("WND", ["SUN", "WND"], [], "x", "Photovoltaic power generation facility"),
    ("sun", [], ["Solar Thermal without storage"], "x", "Thermal solar power facility"),
    ("WND", [], ["Offshore Wind Turbine"], "x", "Off-shore wind power generation facility"),
    ("WND", [], [], "Big off-shore park", "Off-shore wind power generation facility"),
    ("WAT", [], ["Hydroelectric Pumped Storage"], "x", "Pumped hydroelectric storage facility"),
    ("WAT", [], ["Conventional Hydroelectric"], "x", "Hydroelectric dam"),
    ("NG", ["MWH"], [], "x", "Battery storage unit"),
    ("NG", [], [], "Bay Battery 2", "Battery storage unit"),
    (None, ["ZZ", "GEO", "NUC"], [], "x", "Geothermal power plant"),
    ("NUC", ["GEO"], [], "x", "Nuclear power plant"),
    ("RC", [], [], "x", "Coal power Plant"),
    ("LFG", [], [], "x", "Biomass power plant"),
    ("MSW", [], [], "x", "Waste to power facility"),
    ("DFO", ["NG"], [], "x", "Other power plant"),
    (None, [], [], None, "Other power plant"),
]


def test_asset_type_rules(spark):
    df = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(CASES)], "i int, p string, f array<string>, t array<string>, n string")
    got = dict(df.select("i", export.infer_asset_type("p", "f", "t", F.col("n"))).collect())
    assert [got[i] for i in range(len(CASES))] == [c[4] for c in CASES]


# -- export --------------------------------------------------------------------------

PLAIN = export.ExportOptions("r1", "2026-07-01T00:00:00+00:00", "2026", asset_value_source="capex_proxy")


@pytest.fixture(scope="module")
def lookups(spark):
    types = [("Hydroelectric dam", "D35.12", "S", "IC7030", "Hydro"), ("Gas power Plant", "D35.11", "S", "IC1010", "IPP")]
    return (
        spark.createDataFrame(types, "asset_type string, nace_code string, sector string, ticcs_class string, ticcs_class_name string"),
        spark.createDataFrame([("United States", "USA")], "country string, iso3 string"),
    )


def exported(spark, reg, lookups, opts, *side):
    index = sidecar.index_sidecar(side_rows(spark, *side)) if side else export.empty_sidecar_index(spark)
    scope = registry.scope_plants(reg, [U[1], U[2]])
    return export.export_rows(scope, index, *lookups, opts)


def codes(df):
    return {r[0]: (r[1], r[2]) for r in df.select("portfolio_asset_id", pipe_join("errors"), pipe_join("warnings")).collect()}


def test_numbers_beyond_the_decimal_reject_the_row(spark, reg, lookups):
    huge = "1" * 25
    side = {"portfolio_asset_id": "m1", "asset_value": huge, "revenues": "1e30", "detention_rate": "0.5"}
    rows = exported(spark, reg, lookups, PLAIN, side)
    found = [e for errors, _ in codes(rows).values() for e in errors.split("|") if e.startswith("number_")]
    assert found == ["number_out_of_range:asset_value", "number_out_of_range:revenues"]
    assert export.accepted(rows).where("portfolio_asset_id = 'm1'").count() == 0
    # twenty whole digits still fit, and unreadable text stays what it was
    fits = exported(spark, reg, lookups, PLAIN, {**side, "asset_value": "9" * 20, "revenues": "n/a"})
    assert not any("number_" in errors for errors, _ in codes(fits).values())
    assert "9" * 20 in [r[0] for r in export.manifest_rows(fits, PLAIN).select("asset_value").collect()]


def test_proxy_value_and_codes(spark, reg, lookups):
    rows = exported(spark, reg, lookups, PLAIN)
    manifest = {r["portfolio_asset_id"]: r.asDict() for r in export.manifest_rows(rows, PLAIN).collect()}
    assert manifest["m1"]["asset_value"] == "246032561.8751"
    assert manifest["m1"]["asset_value_source"] == export.PROXY_SOURCE
    assert (manifest["m1"]["latitude"], manifest["m1"]["total_capacity_mw"]) == ("47.5", "103.9")
    assert manifest["m1"]["scr_asset_name"] == "is_p_" + U[1].replace("-", "")
    assert manifest["m1"]["address"] == "Pierce County, WA, USA"
    assert manifest[""]["validation_status"] == "rejected"
    got = codes(rows)
    assert got["m1"] == (
        "",
        "missing_revenues_template_marks_mandatory|asset_value_uses_capex_proxy_not_true_valuation|missing_detention_rate",
    )
    assert got[None] == (
        "missing_latitude|missing_longitude",
        "missing_address|missing_revenues_template_marks_mandatory|missing_asset_value_capex_proxy_unavailable|missing_detention_rate",
    )


def test_require_asset_value_hides_the_strict_code(spark, reg, lookups):
    strict = replace(PLAIN, strict=True, asset_value_source="sidecar", detention_rate="0.5")
    assert codes(exported(spark, reg, lookups, strict))["m1"][0] == "missing_revenues_strict|missing_asset_value_strict"
    both = replace(strict, require_asset_value=True)
    assert codes(exported(spark, reg, lookups, both))["m1"] == (
        "missing_revenues_strict|missing_asset_value",
        "missing_revenues_template_marks_mandatory|missing_asset_value",
    )


def test_sidecar_values_unknown_type_and_country(spark, reg, lookups):
    side = {
        "plant_uuid": U[1], "asset_value": "1,000.50", "revenues": "0", "detention_rate": "0.25", "asset_type": "Dam", "country": "Atlantis",
        "address": "Here 1", "year": "02024", "operating_entity_name": "Op", "scope_1": "12", "flood_barriers": "",
    }
    opts = replace(PLAIN, include_operating_entity=True)
    rows = exported(spark, reg, lookups, opts, side)
    got = codes(rows)["m1"]
    assert got == ("asset_type_not_in_template:Dam", "country_code_not_found:Atlantis")
    upload = {r["asset_name"]: r.asDict() for r in export.upload_values(rows).collect()}["is_p_" + U[1].replace("-", "")]
    assert (upload["asset_value"], upload["revenues"], upload["detention_rate"], upload["year"]) == ("1000.5", "0", "0.25", "2024")
    assert (upload["operating_entity_name"], upload["scope_1"], upload["flood_barriers"], upload["ticcs_class"]) == ("Op", "12", "", "")
    assert export.manifest_rows(rows, opts).where("portfolio_asset_id = 'm1'").collect()[0]["valuation_year"] == "02024"


def test_operating_entity_is_off_by_default(spark, reg, lookups):
    rows = exported(spark, reg, lookups, PLAIN, {"plant_uuid": U[1], "operating_entity_name": "Op"})
    assert set(column(export.upload_values(rows), "operating_entity_name")) == {""}


def messages(rows, kind):
    return {r["message"]: r["n"] for r in runs.message_counts(rows).where(F.col("kind") == kind).collect()}


def test_run_totals_add_up(spark, reg, lookups):
    rows = exported(spark, reg, lookups, PLAIN)
    total = runs.job_status(runs.run_totals(rows)).collect()[0]
    assert total["selected_rows"] == total["accepted_rows"] + total["rejected_rows"] == 3
    assert (total["status"], total["exit_code"]) == ("completed with rejects", 2)
    assert messages(rows, "error") == {"missing_latitude": 1, "missing_longitude": 1}
    accepted, rejected = export.split_accepted(rows)
    assert (accepted.count(), rejected.count()) == (2, 1)
    assert dict(runs.preupload_check(rows).select("rule", "passed").collect()) == {
        "rejected_rows_is_zero": False, "operating_entity_is_off": True, "no_warnings_to_review": False, "has_accepted_rows": True,
    }


@pytest.mark.parametrize("partitions", [1, 5])
def test_batches_are_full_and_in_order(spark, partitions):
    df = spark.range(2500).select(F.lit("one workspace").alias("w"), F.format_string("%06d", "id").alias("name"))
    got = runs.numbered(df.repartition(3), [F.col("w"), F.col("name")], partitions)
    assert got.where(F.col("row_number") != F.col("name").cast("bigint") + 1).count() == 0
    batches = runs.batch_uploads(df, [F.col("w"), F.col("name")])
    assert values(batches.groupBy("batch_id").count()) == [(0, 1001), (1, 1001), (2, 498)]


# -- golden counts of a run rebuilt from its shapes ----------------------------------------


def test_run_of_25_plants(spark, lookups):
    """23 index plants and 2 user-added ones without coordinates; 3 plants lack a capital cost."""
    fuels = ["NG"] * 10 + ["WAT"] * 4 + ["SUN"] * 4 + ["WND"] * 3 + ["MWH"] * 2 + ["DFO"] * 2
    plants = [
        (f"{i:08d}-0000-0000-0000-000000000000", None if i > 23 else i, f"plant-{i}", "user_added" if i > 23 else "eia", None,
         "{}" if i > 23 else '{"lat": 47.5, "lon": -121.5, "county": "Pierce", "state": "WA"}')
        for i in range(1, 26)
    ]
    index = [(i, None, None, None, None, "WA", None, None, None, fuels[i - 1], [fuels[i - 1]], [], 10.0) for i in range(1, 24)]
    empty = dict(
        workspace="id string, slug string, deleted_at string",
        workspace_asset="workspace_id string, plant_id string, state string",
        portfolio="id string, workspace_id string, name string, kind string, created_at string, deleted_at string",
        portfolio_asset="id string, workspace_id string, portfolio_id string, reference_plant_id string, is_baseline boolean, deleted_at string",
    )
    reg = Registry(
        spark.createDataFrame(plants, "id string, eia_plant_id int, slug string, source_type string, workspace_id string, data string"),
        spark.createDataFrame(
            index,
            "plant_id int, plant_name string, utility_eia_name string, canonical_owner string, gem_parent_name string, state string,"
            "county string, lat double, lon double, primary_fuel string, fuel_types array<string>, technologies array<string>, total_capacity_mw double",
        ),
        spark.createDataFrame([(p[0], 1054.512939) for p in plants[:20]], "plant_id string, latest_capex_per_kw double"),
        **{name: spark.createDataFrame([], ddl) for name, ddl in empty.items()},
    )
    types = spark.createDataFrame([(t, "", "", "", "") for t in sorted({*export.FUEL_ASSET_TYPES.values()})], lookups[0].schema)
    opts = replace(PLAIN, require_asset_value=True)
    rows = export.export_rows(registry.scope_reference(reg), export.empty_sidecar_index(spark), types, lookups[1], opts)
    assert runs.run_totals(rows).collect()[0].asDict() == {"selected_rows": 25, "accepted_rows": 20, "rejected_rows": 5, "rows_with_warnings": 25}
    assert messages(rows, "error") == {"missing_asset_value": 5, "missing_latitude": 2, "missing_longitude": 2}
    warned = messages(rows, "warning")
    assert warned["asset_value_uses_capex_proxy_not_true_valuation"] == 20
    assert warned["missing_asset_value_capex_proxy_unavailable"] == 5
    assert warned["missing_detention_rate"] == warned["missing_revenues_template_marks_mandatory"] == 25
    assert dict(rows.groupBy("asset_type").count().collect())["Gas power Plant"] == 10


def test_join_back(spark):
    digits = U[1].replace("-", "")
    manifest = spark.createDataFrame(
        [(0, f"is_p_{digits}", U[1], "p1"), (1, f"is_p_{digits}", U[1], ""), (2, "", U[2], "p2"), (3, "is_p_" + "2" * 32, U[2], "p2")],
        "seq long, scr_asset_name string, plant_uuid string, portfolio_id string",
    )
    unique = assets.dedupe_manifest(manifest)
    assert values(unique, "scr_asset_name", "manifest.portfolio_id") == [(f"is_p_{digits}", None), ("is_p_" + "2" * 32, "p2")]
    results = spark.createDataFrame([(f"is_p_{digits}",), ("other",), ("is_p_" + "2" * 32,), (None,)], "assetName string")
    joined = assets.join_back(results, unique, "assetName")
    assert values(joined.where("manifest IS NULL"), "assetName") == [("other",), (None,)]
    assert values(assets.unmatched_assets(results, unique)) == [("other", 1)]
    assert values(assets.uuid_mismatches(results, unique), "assetName") == [("is_p_" + "2" * 32,)]
    plants = spark.createDataFrame([(U[1], "plant-1")], "id string, slug string")
    assert values(assets.recover_plants(results, plants).where("recovered"), "plant_slug") == [("plant-1",)]


def test_capex_proxy_keeps_every_digit(spark):
    df = spark.createDataFrame([("0.000001", "0.000001"), ("103.9", "2367.974609"), ("9999999999.5", "0.000000001")], "a string, b string")
    typed = df.select(F.col("a").cast(registry.CAPACITY).alias("a"), F.col("b").cast(registry.CAPEX).alias("b"))
    got = column(typed.select(decimal_text(export.capex_proxy("a", "b")).alias("v")), "v")
    assert sorted(got) == ["0.000000001", "246032561.8751", "9999.9999995"]
