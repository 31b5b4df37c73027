import csv
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from hazardlens.functions.text import normalize_header, normalize_key
from hazardlens.operators import assets, export, registry, runs, sidecar, transition
from hazardlens.operators.quality import ImportFailure
from hazardlens.plans import import_run, reports, result_build
from hazardlens.plans.export_run import run_export
from hazardlens.schemas import (
    PHYSICAL_REQUIRED,
    SIDECAR_FIELDS,
    TRANSITION_REQUIRED,
    UPLOAD_LAYOUT,
)
from hazardlens.sinks import writers
from hazardlens.sinks.history import History
from hazardlens.sources import tables, workbooks
from hazardlens.streaming.arrivals import arriving_workbooks, import_arrivals, import_batch

from build import column, sheet, values, workbook
from build import physical as phys
from build import transition as trans
from test_registry_export import PLAIN, U, lookups, reg  # noqa: F401


def put(folder, name, content):
    folder.mkdir(exist_ok=True)
    mode = "wb" if isinstance(content, bytes) else "w"
    with open(folder / name, mode) as out:
        out.write(content)
    return str(folder / name)


def output(header, *rows):
    return workbook({"ReadMe": sheet([["assetName", "a1"]]), "Output": sheet([header, *rows])})


FIRST = ["assetName", "scenario", "timeHorizon", "hazard", "indicatorValue", "more"]
HEADER = FIRST + [c for c in PHYSICAL_REQUIRED if c not in FIRST]
RETURNED = ["assetName", "scenario", "subrisk"] + [c for c in TRANSITION_REQUIRED if c not in ("assetName", "scenario", "subrisk")]


# -- workbooks -------------------------------------------------------------------------


def test_workbooks_of_a_folder(spark, tmp_path):
    folder = tmp_path / "returns"
    put(folder, "one.xlsx", output(HEADER, ["a1", "s", 2025.0, "Flood", 1.5, "x"], ["a1", "s", "Historical"], [None, ""], ["a1", "s", 2030, "Heat", "n/a", None, "beyond"]))
    put(folder, "two.xlsx", workbook({"Other": sheet([["a"]])}))
    put(folder, "three.xlsx", b"not a workbook")
    rows = workbooks.read_returns(spark, str(folder), "physical")
    good = rows.where("_corrupt IS NULL")
    assert values(good, "seq", "timeHorizon", "hazard", "indicatorValue", "extra") == [
        (0, "2025", "Flood", 1.5, {"more": "x"}),
        (1, "Historical", None, None, {}),
        (2, "2030", "Heat", None, {"more": None}),
    ]
    assert sorted(column(rows.where("_corrupt IS NOT NULL"), "_corrupt"))[1] == "no sheet Output"
    headers = workbooks.read_headers(spark, str(folder))
    assert values(headers.where("error IS NULL"), "kind", "columns") == [("physical", HEADER)]
    assert headers.where("error IS NOT NULL").count() == 2
    assert values(workbooks.read_readme(spark, str(folder / "one.xlsx")), "readme_asset_name") == [("a1",)]


def test_mixed_folder(spark, tmp_path):
    folder = tmp_path / "mixed"
    put(folder, "p.xlsx", output(HEADER, ["a1", "s", 2025, "Flood", 1.5]))
    put(folder, "t.xlsx", output(RETURNED, ["a1", "s", "X"]))
    kinds = {k: workbooks.readable(workbooks.read_returns(spark, str(folder), k, mixed=True)) for k in ("physical", "transition")}
    assert values(kinds["physical"], "assetName", "hazard") == [("a1", "Flood")]
    assert values(kinds["transition"], "assetName", "subrisk") == [("a1", "X")]
    put(folder, "u.xlsx", output(["assetName", "scenario"], ["a1", "s"]))
    assert values(workbooks.read_headers(spark, str(folder)), "kind") == [("physical",), ("transition",), (None,)]
    for kind in kinds:
        rows = workbooks.read_returns(spark, str(folder), kind, mixed=True)
        assert values(workbooks.failures(rows), "code") == [("kind_unknown",)]


def test_unusable_workbooks_fail_the_build(spark, tmp_path):
    folder = tmp_path / "returns"
    put(folder, "good.xlsx", output(HEADER, ["a1", "s", 2025, "Flood", 1.5]))
    rows = workbooks.read_returns(spark, str(folder), "physical")
    assert workbooks.readable(rows).count() == 1 and workbooks.failures(rows).count() == 0
    put(folder, "lacks.xlsx", output([c for c in HEADER if c not in ("hazard", "climateZone")] + ["hazard"], ["a1"]))
    put(folder, "other.xlsx", output(RETURNED, ["a1", "s", "X"]))
    rows = workbooks.read_returns(spark, str(folder), "physical")
    assert sorted(column(workbooks.failures(rows), "code")) == ["missing_columns", "wrong_kind"]
    assert [d for d in column(workbooks.failures(rows), "detail") if "climate" in d] == ["climateZone"]
    with pytest.raises(Exception, match="workbook cannot be used"):
        workbooks.readable(rows).count()


def test_a_missing_readme_stops_nothing(spark, tmp_path):
    folder = tmp_path / "returns"
    put(folder, "a.xlsx", workbook({"Output": sheet([HEADER])}))
    put(folder, "b.xlsx", b"junk")
    put(folder, "c.xlsx", output(HEADER))
    rows = workbooks.read_readme(spark, str(folder))
    assert values(rows.where("error is null"), "readme_asset_name") == [("a1",)] and rows.where("error is not null").count() == 2


def test_cell_types(spark):
    cells = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>9</v></c><c r="C1" t="b"><v>1</v></c>'
        '<c r="E1"><v>1e3</v></c><c r="F1" t="str"><v>t</v></c><c r="G1"/><c><v>5</v></c><c r="AA1"><v>007</v></c></row>'
    )
    row = next(workbooks.sheet_rows(workbook({"Output": cells}, ["first"]), "Output"))
    assert row[:7] == ["first", "9", True, None, 1000.0, "t", None]
    assert (len(row), row[26]) == (27, 7)


def test_template_lookups(spark, tmp_path):
    blank = [None] * 3
    types = sheet([["t"], ["t"], ["t"], ["h"], ["Dam", None, None, "N1", "S1", *blank, "C1", "CN1"], ["Dam", None, None, "N2"], ["", "x"]])
    countries = sheet([["Country", "Code"], ["Peru", "PER"], ["Nowhere", None]])
    path = put(tmp_path, "template.xlsx", workbook({"Asset types": types, "Country code": countries}))
    assert values(tables.read_asset_types(spark, path)) == [("Dam", "N2", "", "", "")]
    assert values(tables.read_country_codes(spark, path)) == [("Peru", "PER")]


# -- CSV and Parquet -------------------------------------------------------------------


def test_long_csv_and_parquet(spark, tmp_path):
    header = [c for c in PHYSICAL_REQUIRED]
    rows = [dict.fromkeys(header, ""), dict.fromkeys(header, "")]
    rows[0].update(assetName="a", scenario="s", timeHorizon="2030", adjustedTotalValueImpact="1.5", adjustedTotalDisruption="x")
    rows[1].update(assetName="a", scenario="s", timeHorizon="2030", adjustedTotalValueImpact="2.5")
    path = tmp_path / "long.csv"
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, header)
        writer.writeheader()
        writer.writerows(rows)
    df = tables.read_long(spark, str(path), fmt="csv")
    assert values(df.orderBy("seq"), "adjustedTotalValueImpact", "adjustedTotalDisruption", "totalDamage") == [(1.5, None, None), (2.5, None, None)]
    first, last = [r["adjustedTotalValueImpact"] for r in df.orderBy("seq").collect()]
    assert (first, last) == (1.5, 2.5)
    spark.createDataFrame(rows).write.parquet(str(tmp_path / "pq"))
    assert tables.read_long(spark, str(tmp_path / "pq")).count() == 2
    with pytest.raises(ImportFailure):
        tables.conform_long(df.drop("climateZone"))


def test_rows_keep_their_order_over_split_files(spark, tmp_path):
    path = put(tmp_path, "many.csv", "assetName,n\n" + "".join(f"a{i},{i}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = tables._with_place(spark.read.csv(path, header=True), parquet=False)
        assert df.rdd.getNumPartitions() > 5
        ordered = [r["n"] for r in df.orderBy("seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == [str(i) for i in range(20000)]


def test_manifest_csv(spark, tmp_path):
    text = 'scr_asset_name,plant_uuid,portfolio_id,address\nn1,u1,p1,"A, ""B"""\n,u0,,\nn1,u1,p2,\n'
    got = tables.read_manifest(spark, put(tmp_path, "m.csv", text))
    assert values(got, "scr_asset_name", "manifest.portfolio_id", "manifest.address") == [("n1", "p2", None)]


def test_sidecar_csv_aliases_and_doubled_headers(spark, tmp_path):
    text = "Plant ID,Asset Value USD,Revenue,revenues,Country,My Note,Revenue\n u1 ,5,1,2,Peru,hi,\nu2,6,1,,Chile,,7\n"
    got = tables.read_sidecar(spark, put(tmp_path, "s.csv", text))
    assert values(got, "plant_uuid", "asset_value", "revenues", "country", "my_note", "address") == [
        ("u1", "5", "", "Peru", "hi", ""), ("u2", "6", "7", "Chile", "", ""),
    ]
    assert set(SIDECAR_FIELDS) <= set(got.columns)
    assert set(column(sidecar.index_sidecar(got, ["source_file", "seq"]), "_key")) == {"u1", "u2"}


def test_uuid_ranges_cover_everything_once():
    ranges = tables.uuid_ranges("id", 4)
    assert "id >= '00000000-" in ranges[0] and "id < '40000000-" in ranges[0] and "id IS NULL" in ranges[0]
    assert ranges[-1] == "id >= 'c0000000-0000-0000-0000-000000000000'"


def test_registry_and_vocabulary_files(spark, tmp_path, reg):  # noqa: F811
    for name in tables.REGISTRY_TABLES:
        getattr(reg, name).write.parquet(f"{tmp_path}/reg/{name}")
    again = tables.read_registry(spark, f"{tmp_path}/reg")
    assert values(registry.scope_portfolio(again, "p1"), "plant_uuid") == [(U[1],)]
    path = put(tmp_path, "v.csv", "Indicator,Unit\nFlood depth,m\nFlood depth,m\n,\n")
    assert values(tables.read_vocabulary(spark, path, "Indicator")) == [("Flood depth",)]
    path = put(tmp_path, "c.csv", "country,iso3\nPeru,X\nPeru,PER\n,\n")
    assert values(tables.read_lookup_csv(spark, path, "country")) == [("Peru", "PER")]


# -- export run ----------------------------------------------------------------------------


def read_one_csv(folder):
    files = sorted(p for p in folder.rglob("*.csv"))
    rows = []
    for path in files:
        with open(path, newline="") as f:
            rows += list(csv.reader(f))[1:]
    with open(files[0], newline="") as f:
        return next(csv.reader(f)), rows


@pytest.mark.parametrize("batched", [False, True])
def test_export_run_writes_four_files(spark, tmp_path, reg, lookups, batched):  # noqa: F811
    opts = replace(PLAIN, run_id="run7")
    scope = registry.scope_plants(reg, [U[1], U[2]])
    result = run_export(scope, *lookups, opts, str(tmp_path), batched=batched, workspace_slug="demo")
    assert (result["status"], result["exit_code"], result["accepted_rows"]) == ("completed with rejects", 2, 2)
    header, rows = read_one_csv(tmp_path / "run7" / "upload")
    assert header == [h for _, h in UPLOAD_LAYOUT] and len(header) == 58 and "Wildfire: Undergrouding" in header
    assert len(rows) == 2 and rows[0][10] == "Pierce County, WA, USA" and rows[0][7] == ""
    header, rows = read_one_csv(tmp_path / "run7" / "manifest")
    assert len(header) == 36 and len(rows) == 3
    assert len(read_one_csv(tmp_path / "run7" / "rejects")[1]) == 1
    text = next((tmp_path / "run7" / "run_summary").glob("part-*")).read_text()
    summary = json.loads(text)
    assert (summary["scr_run_id"], summary["workspace_slug"], summary["rejected_rows"]) == ("run7", "demo", 1)
    messages = spark.read.json(str(tmp_path / "run7" / "run_summary_messages"))
    assert values(messages.where("kind = 'error'"), "message", "n") == [("missing_latitude", 1), ("missing_longitude", 1)]


def test_manifest_round_trip(spark, tmp_path, reg, lookups):  # noqa: F811
    scope = registry.scope_plants(reg, [U[1]])
    rows = export.export_rows(scope, export.empty_sidecar_index(spark), *lookups, PLAIN)
    writers.write_manifest(rows, str(tmp_path / "m"), PLAIN)
    back = tables.read_manifest(spark, str(tmp_path / "m"))
    assert values(back, "manifest.plant_uuid", "manifest.asset_value") == [(U[1], "246032561.8751")]


# -- results and imports ----------------------------------------------------------------------


def test_build_write_and_reopen_results(spark, tmp_path):
    p = phys(spark, {"indicatorRating": "C", "adjustedHazardValueImpact": 1.0}, {"timeHorizon": "Historical"})
    t = trans(spark, {"adjustedSubriskRevenueImpact": 2.0})
    built = result_build.build_results(p, t)
    meta = result_build.build_meta(p, t, "2026-07-01", physical_source="p.xlsx")
    writers.write_results(built, str(tmp_path / "res"), meta)
    again = tables.read_results(spark, str(tmp_path / "res"))
    assert values(again.hazards, "hazard", "adjusted_hazard_value_impact") == [("Flood", 1.0)]
    assert values(again.rankings, "peak_subrisk", "peak_impact") == [("X", 2.0)]
    assert values(spark.read.parquet(f"{tmp_path}/res/meta"), "physical_rows", "transition_rows") == [(2, 1)]
    plan = again.trends.where("scenario = 's'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(scenario" in plan
    ordered = result_build.in_report_order(again.hazards, "physical_hazards")
    assert ordered.count() == 1


def test_build_needs_all_required_columns(spark):
    p, t = phys(spark, {}), trans(spark, {})
    with pytest.raises(ImportFailure, match="physical lacks climateZone; transition lacks subrisk"):
        result_build.build_results(p.drop("climateZone"), t.drop("subrisk"))
    assert (len(PHYSICAL_REQUIRED), len(TRANSITION_REQUIRED)) == (22, 18)


def manifest_for(spark, *names):
    rows = [(i, n, "run", n[5:13] + "-" + n[13:17] + "-" + n[17:21] + "-" + n[21:25] + "-" + n[25:], f"m{i}") for i, n in enumerate(names)]
    return assets.dedupe_manifest(spark.createDataFrame(rows, "seq long, scr_asset_name string, scr_run_id string, plant_uuid string, portfolio_asset_id string"))


def test_import_checks_history_and_rerun(spark, tmp_path):
    name = "is_p_" + "a" * 32
    manifest = manifest_for(spark, name)
    rows = phys(spark, {"assetName": name}, {"assetName": name, "timeHorizon": "2035"})
    headers = spark.createDataFrame([("p", ["hazard"], None)], "source_file string, columns array<string>, error string")
    import_run.check_import(headers, rows, manifest)
    with pytest.raises(ImportFailure, match="asset_not_in_manifest"):
        import_run.check_import(headers, phys(spark, {"assetName": "other"}), manifest)
    with pytest.raises(ImportFailure, match="kind_unknown"):
        import_run.check_import(headers.withColumn("columns", F.array(F.lit("x"))), rows, manifest)
    folder = str(tmp_path / "history")
    for import_id in ("i1", "i2", "i2"):
        done = import_run.normalize_import(rows, manifest, import_id, "2026-07-01")
        summary = import_run.import_manifest(done, manifest, "physical")
        writers.write_import(folder, import_id, physical=done, summary=summary)
    history = History(spark, folder)
    with pytest.raises(ImportFailure, match="i2 is in"):
        history.append("i2", physical_long=import_run.normalize_import(rows.limit(1), manifest, "i2", "2026-07-02"))
    kept = history.read("physical_long")
    assert values(kept.groupBy("import_id").count()) == [("i1", 2), ("i2", 2)]
    assert values(kept.select("scr_run_id", "portfolio_asset_id").distinct()) == [("run", "m0")]
    listed = history.read("import_manifest")
    assert values(listed, "import_id", "row_count", "asset_count", "matched_asset_count", "output_type") == [
        ("i1", 2, 1, 1, "physical"), ("i2", 2, 1, 1, "physical"),
    ]
    assert import_run.keep_named(phys(spark, {}, {"scenario": ""})).count() == 1


def test_arriving_workbooks_become_imports(spark, tmp_path):
    name = "is_p_" + "b" * 32
    inbox = tmp_path / "inbox"
    args = dict(kind="physical", manifest=manifest_for(spark, name), history=str(tmp_path / "h"), checkpoint=str(tmp_path / "c"), imported_at=lambda n: f"2026-07-0{n + 1}")
    for n in range(2):
        put(inbox, f"{n}.xlsx", output(HEADER, [name, "s", 2025 + n, "Flood", 1.0, None]))
        import_arrivals(arriving_workbooks(spark, str(inbox)), **args).awaitTermination()
    history = History(spark, str(tmp_path / "h"))
    got = history.read("physical_long")
    assert values(got, "timeHorizon", "scr_run_id") == [("2025", "run"), ("2026", "run")]
    assert all(i.startswith("physical-") for i in column(got, "import_id"))
    # a new checkpoint delivers both files again, one under another name, repacked, beside a new one
    put(inbox, "copy of 1.xlsx", output(HEADER, [name, "s", 2026.0, "Flood", 1.0, None], [None, ""]))
    put(inbox, "new.xlsx", output(HEADER, [name, "s", 2027, "Flood", 1.0, None]))
    import_arrivals(arriving_workbooks(spark, str(inbox)), **{**args, "checkpoint": str(tmp_path / "c2")}).awaitTermination()
    assert values(history.read("physical_long"), "timeHorizon") == [("2025",), ("2026",), ("2027",)]
    arrived = history.read("arrivals").select("repeat", *(F.element_at(F.split(c, "/"), -1).alias(c) for c in ("source_file", "repeat_of")))
    assert [(f.replace("%20", " "), of) for r, f, of in values(arrived) if r] == [("0.xlsx", "0.xlsx"), ("1.xlsx", "1.xlsx"), ("copy of 1.xlsx", "1.xlsx")]
    assert arrived.where("not repeat").count() == 3


def test_equal_files_in_one_import(spark, tmp_path):
    name = "is_p_" + "d" * 32
    books = [("b", output(HEADER, [name, "s", 2025])), ("a", output(HEADER, [name, "s", 2025])), ("c", output(HEADER, [name, "s", 2026]))]
    files = spark.createDataFrame([(n, bytearray(c)) for n, c in books], "path string, content binary")
    history = History(spark, str(tmp_path))
    for _ in range(2):  # again as after a failure: the import is known
        import_batch(files, "physical", manifest_for(spark, name), history, "i", "2026-07-01")
    assert values(history.read("arrivals"), "source_file", "repeat", "repeat_of") == [("a", False, None), ("b", True, "a"), ("c", False, None)]
    assert values(history.read("physical_long"), "source_file") == [("a",), ("c",)] and history.version() == 0


def test_numbering_uses_the_shared_folder(spark):
    df = spark.range(10)
    assert values(runs.numbered(df, [F.col("id")]), "id", "row_number") == [(i, i + 1) for i in range(10)]
    assert spark.sparkContext.getCheckpointDir()


def test_portfolio_report(spark):
    names = ["is_p_" + c * 32 for c in "ab"]
    manifest = spark.createDataFrame([(i, n, "p1") for i, n in enumerate(names)], "seq long, scr_asset_name string, portfolio_id string")
    manifest = assets.dedupe_manifest(manifest.withColumns({c: F.lit("x") for c in ("portfolio_asset_id", "plant_uuid")}))
    p = phys(
        spark,
        *[{"assetName": n, "scenario": "s", "adjustedPhysicalExposureRating": r, "adjustedTotalValueImpact": v, "ticcsSubClass": "IC1"}
          for n, r, v in zip(names, "AD", (9.0, 1.0))],
    )
    t = trans(spark, {"assetName": names[0], "adjustedSubriskRevenueImpact": 4.0})
    report = reports.portfolio_report(
        result_build.build_results(p, t), manifest, "s", 2030, ["s"], k=1
    )
    assert values(report["ratings"], "portfolio_rating", "rated") == [("C", 2)]
    assert values(report["top_assets"], "asset_name") == [(names[1],)]
    assert values(report["sectors"].where("level = 3"), "n_assets", "worst_rating", "max_value") == [(2, "D", 9.0)]
    assert values(report["top_subrisks"], "peak_subrisk", "max_value") == [("X", 4.0)]
    assert values(report["scenarios"], "horizon", "s") == [(2030, 9.0)]


def test_export_order_is_total(spark, reg):  # noqa: F811
    rows = registry.in_export_order(registry.scope_plants(reg, [U[1], U[2]]))
    assert column(rows, "portfolio_asset_id") == ["m1", "m2", None]
    assert registry.in_export_order(registry.scope_plants(reg, [U[1]]), limit=1).count() == 1


def test_import_package(spark, tmp_path):
    name = "is_p_" + "c" * 32
    manifest = manifest_for(spark, name)
    rows = phys(spark, {"assetName": name, "hazard": "Flood"}, {"assetName": name, "hazard": "Hail", "timeHorizon": "2035"})
    source = rows.first()["source_file"]
    headers = spark.createDataFrame([(source, ["hazard"], None)], "source_file string, columns array<string>, error string")
    readme = spark.createDataFrame([(source, "another")], "source_file string, readme_asset_name string")
    terms = spark.createDataFrame([("FLOOD",), ("HEAT",)], "term string")
    folder = str(tmp_path / "imports")
    args = (manifest, "physical", "i1", "2026-07-01", folder, {"hazard": terms}, ["indicatorValue"])
    done = [import_run.import_returns(rows, *args, readme=readme, headers=headers) for _ in range(2)]
    assert done[0] == {"rows": 2, "blank_names": 0, "blank_metrics": 2, "unusable_files": 0, "warnings": 4, "version": 0}
    assert done[1] == {**done[0], "version": None}
    read = {n: History(spark, folder).read(n) for n in ("physical_long", "import_manifest", "import_warnings")}
    assert read["physical_long"].count() == 2 and spark.read.parquet(f"{folder}/import_failures/i1").count() == 0
    codes = column(read["import_warnings"], "code")
    assert {"hazard_not_in_metadata", "hazard_not_returned", "readme_name_differs"} <= set(codes)
    assert values(read["import_manifest"], "import_id", "row_count", "warning_count") == [("i1", 2, len(codes))]
    with pytest.raises(ImportFailure, match="1 x asset_not_in_manifest"):
        import_run.import_returns(phys(spark, {"assetName": "other"}), *args, headers=headers)
    assert spark.read.parquet(f"{folder}/import_failures/i1").count() == 1


def test_ties_over_files_do_not_depend_on_input_order(spark):
    order = ("source_file", "seq")
    rows = trans(spark, *[{"source_file": f, "seq": 0, "adjustedSubriskRevenueImpact": 7.0, "adjustedSubriskExposureRating": r} for f, r in (("b", "G"), ("a", "A"), ("c", "C"))])
    for parts in (1, 7):
        evidence = transition.subrisk_rows(rows.repartition(parts), order)
        assert values(transition.best_impact(evidence, ["asset_name"]), "rating") == [("A",)]
        assert column(reports.subrisk_table(evidence, k=1), "rating") == ["A"]
    spelled = {h: column(spark.createDataFrame([(h,)], "h string").select(normalize_key("h").alias("k")), "k")[0] for h in HEADERS}
    assert spelled == {h: normalize_header(h) for h in HEADERS}


HEADERS = [" Asset Value (USD)", "ÄSSET é", "İd", "a__b", "Straße 1", "_x_", "", "K"]


def test_sidecar_files_with_other_column_orders(spark, tmp_path):
    put(tmp_path / "side", "a.csv", "plant_uuid,asset_value\nu1,5\n")
    put(tmp_path / "side", "b.csv", 'Asset Value,"Plant ID",note\n6,u2,"x, y"\n7,u3\n')
    rows = tables.read_sidecar(spark, str(tmp_path / "side"))
    assert values(rows, "plant_uuid", "asset_value", "note") == [("u1", "5", ""), ("u2", "6", "x, y"), ("u3", "7", "")]
