import math

import pytest
from pyspark.sql import functions as F

from hazardlens.functions import display, numbers, ratings, text

from build import column, text_frame, values


def results(spark, fn, inputs):
    rows = spark.createDataFrame(list(enumerate(inputs)), "i int, x string").select("i", fn("x").alias("y")).collect()
    return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]


def test_parse_float(spark):
    got = results(spark, numbers.parse_float, ["1.5", " 2 ", "", None, "x", "1d", "1f", "NaN", "inf", "-inf", "1e3"])
    assert got[:2] == [1.5, 2.0]
    assert got[2:7] == [None] * 5
    assert math.isnan(got[7])
    assert got[8:] == [math.inf, -math.inf, 1000.0]


def test_parse_int(spark):
    assert results(spark, numbers.parse_int, ["2025", " 7 ", "2025.0", "Historical", "", None]) == [
        2025, 7, None, None, None, None,
    ]


def test_int_column_cuts_numbers_but_not_text(spark):
    df = spark.createDataFrame([(2025.9,), (float("nan"),), (None,)], "h double")
    assert column(df, numbers.int_column(df, "h")) == [2025, None, None]


def test_rating_score_and_worst(spark):
    assert results(spark, ratings.rating_score, ["A", " g ", "NA", "", None, "H"]) == [1, 7, 0, 0, 0, 0]
    df = spark.createDataFrame([("NA", "F", None), (None, "", "x")], "a string, b string, c string")
    assert column(df, ratings.worst_rating("a", "b", "c")) == ["F", None]


def test_rating_band_and_tone(spark):
    assert results(spark, ratings.rating_band, ["B", "d", "E", None]) == [
        "Lower exposure", "Moderate exposure", "Higher exposure", "No rating",
    ]
    assert results(spark, ratings.rating_tone, ["B", "C", "E", None]) == ["low", "mid", "high", "low"]


def test_decimals(spark):
    parsed = results(spark, lambda c: numbers.as_decimal(c).cast("string"), ["1,234.5", " ", None, "abc", "-0.10"])
    assert parsed == ["1234.500000", None, None, None, "-0.100000"]
    got = results(spark, lambda c: numbers.decimal_text(numbers.as_decimal(c)), ["1,200", "0.50", "0", None, "100.00"])
    assert got == ["1200", "0.5", "0", "", "100"]


def test_long_coordinates_keep_their_digits(spark):
    wide = lambda c: numbers.decimal_text(numbers.as_decimal(c, "decimal(38,18)"))
    assert results(spark, wide, ["47.079722123456", "-121.50", "0"]) == ["47.079722123456", "-121.5", "0"]


def test_share_in_range(spark):
    assert results(spark, numbers.share_in_range, ["0", "1", "0.5", "1.1", "x", " ", None]) == [
        True, True, True, False, False, None, None,
    ]


def test_keys(spark):
    raw = ["Asset Value USD", "  plant id ", "--A--b__", "", None]
    assert results(spark, text.normalize_key, raw) == ["asset_value_usd", "plant_id", "a_b", "", None]
    assert [text.normalize_header(r) for r in raw[:3]] == ["asset_value_usd", "plant_id", "a_b"]
    assert results(spark, text.slug, ["Big Plant #1", "", None, "***"]) == ["big-plant-1", "asset", "asset", "asset"]


@pytest.mark.parametrize("limit, expected", [(40, "is_p_" + "0" * 32), (120, "my-plant__is_p_" + "0" * 32)])
def test_asset_name(spark, limit, expected):
    df = spark.createDataFrame([("00000000-0000-0000-0000-000000000000", "My Plant")], "u string, s string")
    name = text.asset_name("u", "s", max_length=limit)
    assert column(df, name) == [expected]
    assert column(df, text.uuid_from_asset_name(name)) == ["00000000-0000-0000-0000-000000000000"]


def test_uuid_from_other_names(spark):
    digits = "0123456789abcdef" * 2
    names = [f"is_g_{digits}", "plant", None, f"is_p_{digits}x"]
    assert results(spark, text.uuid_from_asset_name, names) == [None] * 4
    generator = lambda c: text.uuid_from_asset_name(c, text.GENERATOR_PREFIX)
    assert results(spark, generator, names[:1]) == ["01234567-89ab-cdef-0123-456789abcdef"]


def test_address_cascade(spark):
    rows = [
        ("Side St 1", "Raw 1", "Town", "Pierce", "WA", "98"),
        (None, "Raw 1", " Town ", "Pierce", "WA", "98"),
        ("", None, "Town", "Pierce", "WA", None),
        (None, "", None, "Pierce", "WA", "98"),
        (None, None, None, "Lake county", "WA", None),
        (None, None, "Town", None, None, "98"),
        (None, None, None, None, "WA", None),
    ]
    df = spark.createDataFrame(rows, "side string, raw string, city string, county string, state string, zip string")
    got = [tuple(r) for r in column(df, text.compose_address("side", "raw", "city", "county", "state", "zip"))]
    assert got == [
        ("Side St 1", "sidecar"),
        ("Raw 1, Town, WA, 98, USA", "plants.data.address"),
        ("Town, WA, USA", "city_state_fallback"),
        ("Pierce County, WA, USA", "county_state_fallback"),
        ("Lake county, WA, USA", "county_state_fallback"),
        ("", "missing"),
        ("WA, USA", "state_fallback"),
    ]


def test_names_for_files_and_listings(spark):
    assert results(spark, text.safe_file_name, ['  a  b-c/d:"x" ', "", None, "   "]) == [
        "a_b_cdx", "asset_export", "asset_export", "",
    ]
    labels = ["x Asset Name :  My plant  Asset type y", "plain ", "asset name:", "Asset name: P Revenues 3"]
    assert results(spark, text.listing_asset_name, labels) == ["My plant", "plain", "", "P"]


def test_points_years_hosts(spark):
    points = results(spark, text.parse_point, ["(47.079722,-122.365)", "( 1 , 2 )", "47,1", None])
    assert [(str(p["lat"]), str(p["lon"])) for p in points[:2]] == [("47.079722", "-122.365000"), ("1.000000", "2.000000")]
    assert [(p["lat"], p["lon"]) for p in points[2:]] == [(None, None)] * 2
    assert results(spark, text.year_value, ["2026", "02026", "FY26", "0"]) == ["2026", "2026", "FY26", "0"]
    assert results(spark, text.url_host, ["postgres://u:p@Db.Example.com:5432/x", "", None]) == ["db.example.com", "", ""]


def test_clean_array(spark):
    df = spark.createDataFrame([(["a", None, "b"],), (None,)], "x array<string>")
    assert column(df, text.pipe_join(text.clean_array("x"))) == ["a|b", ""]


def test_display(spark):
    df = spark.createDataFrame([(0.00089711261,), (None,), (float("nan"),)], "v double")
    assert column(df, display.impact_label("v")) == ["0.0897%", "not quantified", "not quantified"]
    assert column(df, display.impact_label("v", "basis_points", True))[0] == "8.97 bps (raw 0.000897113)"
    assert column(df, display.impact_label("v", "raw"))[0] == "0.000897113 raw"
    assert column(df, display.display_value("v", "basis_points"))[1:] == [None, None]
    assert column(df, display.magnitude_label("v", F.lit("m")))[:2] == ["0.000897113 m", "rating only"]
    numbers_ = spark.createDataFrame([(22.868, 2035), (12.0, 2030), (None, None)], "v double, y int")
    assert column(numbers_, display.peak_label("v", "y")) == ["22.868 @ 2035", "12 @ 2030", "n/a"]


def test_driver_label(spark):
    assert results(spark, display.driver_label, ["Direct_carbon_cost", "Other", "", None, "all"]) == [
        "Direct carbon cost", "Other", "n/a", "n/a", "All drivers",
    ]


def test_first_non_blank_keeps_spaces(spark):
    df = spark.createDataFrame([("", " "), (None, "")], "a string, b string")
    assert column(df, text.first_non_blank("a", "b")) == [" ", None]
    assert values(text_frame(spark, "x", ["\t a "]).select(text.strip("x"))) == [("a",)]
