import pytest
from pyspark.sql import functions as F

from hazardlens.operators import portfolio, quality, vocabulary

from build import physical as phys
from build import text_frame, values


def test_columns_of_both_kinds_are_checked_before_failing():
    with pytest.raises(quality.ImportFailure, match="one lacks b; two lacks c, d"):
        quality.require_columns({"two": (["x"], ["d", "c"]), "one": (["a"], ["a", "b"])})


def test_output_kind():
    assert quality.detect_kind(["a", "hazard"]) == "physical"
    assert quality.detect_kind(["subrisk"]) == "transition"
    with pytest.raises(quality.ImportFailure):
        quality.detect_kind(["Hazard"])


def test_vocabulary_keeps_unknown_terms(spark):
    rows = text_frame(spark, "indicator", ["Subsidence rate", "Flood depth", "flood depth", ""])
    terms = text_frame(spark, "term", ["Flood Depth", "Hail size"])
    assert values(vocabulary.vocabulary_status(rows, "indicator", terms)) == [
        ("Flood depth", 1, "mapped"), ("Subsidence rate", 1, "missing"), ("flood depth", 1, "mapped"),
    ]
    assert values(vocabulary.unused_terms(rows, "indicator", terms), "term") == [("Hail size",)]


def test_scenario_aliases(spark):
    rows = text_frame(spark, "scenario", ["NDCs", "Below 2°C", "Low Demand", " net zero 2050", "Climate Breakdown"])
    assert values(vocabulary.with_scenario_category(rows)) == [
        (" net zero 2050", "Orderly", "SSP2-4.5"),
        ("Below 2°C", "Orderly", "SSP2-4.5"),
        ("Climate Breakdown", "ECI", "SSP5-8.5"),
        ("Low Demand", None, None),
        ("NDCs", "Hot House World", "SSP2-4.5"),
    ]
    assert vocabulary.scenario_table(spark).count() == 8


def test_display_label_falls_back_to_raw(spark):
    rows = text_frame(spark, "x", ["a", "b", "", None])
    labels = spark.createDataFrame([("a", "A label")], "raw string, label string")
    assert values(vocabulary.display_label(rows, "x", labels), "label") == [("A label",), ("b",), ("n/a",), ("n/a",)]


def test_repeats_and_identity(spark):
    df = phys(
        spark,
        {"adjustedHazardValueImpact": 3.0, "adjustedHazardDamage": 1.0, "adjustedHazardDisruptionDamageEquivalent": 2.0},
        {"adjustedHazardValueImpact": 3.0, "adjustedHazardDamage": None, "adjustedHazardDisruptionDamageEquivalent": 2.0},
        {"hazard": "Heat", "adjustedHazardValueImpact": 4.0, "adjustedHazardDamage": 1.0, "adjustedHazardDisruptionDamageEquivalent": 2.0},
        {"hazard": "Heat", "adjustedHazardValueImpact": 5.0},
    )
    keys = ["assetName", "scenario", "timeHorizon", "hazard"]
    assert values(quality.check_repeats(df, keys, ["adjustedHazardValueImpact", "adjustedHazardDamage"]), "hazard", "inconsistent") == [
        ("Heat", "adjustedHazardValueImpact")
    ]
    assert values(quality.check_value_identity(df), "hazard", "difference") == [("Heat", 1.0)]
    assert quality.check_grain(df, [*keys, "indicator"]).count() == 2


def test_coverage_counts_blank_text_as_missing(spark):
    df = phys(spark, {"indicatorRating": "A", "indicatorValue": 1.0}, {"indicatorRating": ""})
    got = quality.coverage(df, {"x": ["indicatorRating", "indicatorValue"], "gone": ["nope"]})
    assert values(got) == [("gone", 0, 2, 0.0), ("x", 2, 4, 0.5)]


def test_portfolio_rating_rounds_half_up_by_default(spark):
    df = spark.createDataFrame([("p", r) for r in ["B", "C", "NA", None]], "portfolio_id string, r string")
    row = portfolio.portfolio_rating(df, ["portfolio_id"], "r").collect()[0]
    assert (row["portfolio_rating"], row["rated"], row["unrated"], row["rating_B"]) == ("C", 2, 2, 1)
    even = portfolio.portfolio_rating(df, ["portfolio_id"], "r", half_up=False)
    assert values(even, "portfolio_rating") == [("B",)]


def test_latest_import_and_drift(spark):
    history = spark.createDataFrame(
        [("i1", "2026-01", "a", "X", 1), ("i2", "2026-02", "a", "Y", 2), ("i1", "2026-01", "b", "Z", 3)],
        "import_id string, imported_at string, assetName string, assetId string, v int",
    )
    assert values(quality.latest_import(history), "v") == [(2,), (3,)]
    assert values(quality.latest_import(history, import_id="i1"), "v") == [(1,), (3,)]
    assert values(quality.id_drift(history)) == [("a", 2)]


def test_coordinates_are_compared_with_a_tolerance(spark):
    found = spark.createDataFrame(
        [("a", "(1.0000001,2)", "USA", "IC101020"), ("b", "(1.1,2)", "USA", "IC101020"), ("c", "(1,2)", "CAN", "IC701020")],
        "asset_name string, coordinates string, country_code string, ticcs_sub_class string",
    )
    manifest = spark.createDataFrame([(n,) for n in "abc"], "scr_asset_name string").withColumn(
        "manifest", F.struct(F.lit("1").alias("latitude"), F.lit("2").alias("longitude"))
    )
    sent = spark.createDataFrame([(n, "USA", "IC1010") for n in "abc"], "scr_asset_name string, country_code string, ticcs_class string")
    assert values(quality.compare_with_manifest(found, manifest, sent)) == [("b", True, False, False), ("c", False, True, True)]


def test_coordinate_grain(spark):
    rows = [("one", 1.0, 2.0), ("one", 1.0, 2.0), ("two", 1.0, 2.0), ("two", 1.0, 3.0), ("part", 1.0, 2.0), ("part", None, None), ("none", None, None)]
    df = spark.createDataFrame(rows, "plant string, lat double, lon double")
    assert values(quality.coordinate_grain(df, "plant"), "plant", "n_pairs", "n_missing") == [("part", 1, 1), ("two", 2, 0)]


def test_readme_mismatch(spark):
    rows = spark.createDataFrame([("f1", "a"), ("f1", "b"), ("f2", "c")], "source_file string, assetName string")
    readme = spark.createDataFrame([("f1", "a"), ("f2", "c")], "source_file string, readme_asset_name string")
    assert values(quality.readme_name_mismatches(readme, rows), "assetName") == [("b",)]
