import math

import pytest

from hazardlens.operators import axes, physical, response, series, transition

from build import physical as phys
from build import transition as trans
from build import values

NAN, INF = math.nan, math.inf


def test_horizon_cast_drops_historical_and_decimal_text(spark):
    df = phys(spark, {"timeHorizon": "2025"}, {"timeHorizon": "Historical"}, {"timeHorizon": "2025.0"}, {"assetName": ""}, {"scenario": None})
    assert values(axes.valid_axes(df), "horizon") == [(2025,)]


def test_trend_takes_last_non_null_and_nan_counts(spark):
    df = phys(
        spark,
        {"adjustedTotalDamage": 5.0, "adjustedTotalDisruption": 1.0},
        {"adjustedTotalDamage": 3.0, "adjustedTotalDisruption": NAN},
        {"adjustedTotalDamage": None},
    )
    row = physical.physical_trends(df).collect()[0]
    assert row["adjusted_total_damage"] == 3.0
    assert math.isnan(row["adjusted_total_disruption"])
    assert row["adjusted_total_value_impact"] is None


def test_trend_rating_does_not_fall_back_over_na(spark):
    df = phys(
        spark,
        {"adjustedPhysicalExposureRating": "NA", "physicalExposureRating": "F", "hazardExposureRating": "F", "adjustedHazardExposureRating": "NA"},
    )
    assert values(physical.physical_trends(df), "adjusted_physical_exposure_rating") == [(None,)]
    assert values(physical.hazard_rollup(df), "hazard_rating") == [("F",)]
    blank = phys(spark, {"adjustedPhysicalExposureRating": "", "physicalExposureRating": "F"})
    assert values(physical.physical_trends(blank), "adjusted_physical_exposure_rating") == [("F",)]


def test_optional_metric_column_may_be_absent(spark):
    df = phys(spark, {"adjustedTotalValueImpact": 1.0}).drop("adjustedTotalDamage", "adjustedHazardDamage")
    assert values(physical.physical_trends(df), "adjusted_total_damage") == [(None,)]
    assert values(physical.hazard_rollup(df), "adjusted_hazard_damage") == [(None,)]


def test_hazard_max_ignores_nan_and_minus_infinity(spark):
    df = phys(spark, *[{"adjustedHazardDamage": v, "adjustedHazardDisruption": w} for v, w in [(NAN, NAN), (2.0, -INF), (None, None), (-INF, NAN)]])
    assert values(physical.hazard_rollup(df), "adjusted_hazard_damage", "adjusted_hazard_disruption") == [(2.0, None)]


def test_rating_counts_take_exact_letters_only(spark):
    df = phys(spark, *[{"indicatorRating": r} for r in ["a", " A", "A", "NA", ""]])
    assert values(physical.hazard_rollup(df), "rating_A", "rating_B") == [(1, 0)]


def test_worst_indicators_ties_keep_file_order(spark):
    df = phys(spark, *[{"indicator": f"i{i}", "indicatorRating": "B", "indicatorValue": 1.0} for i in range(4)])
    assert values(physical.worst_indicators(df), "rank", "indicator") == [(1, "i0"), (2, "i1"), (3, "i2")]


def test_worst_indicators_rating_before_value_and_null_last(spark):
    rows = [("A", 99.0), ("g", None), (" G", 1.0), (None, 500.0), ("G", NAN)]
    df = phys(spark, *[{"indicator": f"i{i}", "indicatorRating": r, "indicatorValue": v} for i, (r, v) in enumerate(rows)])
    assert values(physical.worst_indicators(df), "rank", "indicator") == [(1, "i2"), (2, "i1"), (3, "i4")]


def test_rows_without_hazard_are_evidence_but_no_hazard(spark):
    df = phys(spark, {"hazard": ""}, {"hazard": None}, {"hazard": "Heat"})
    assert axes.indicator_rows(df).count() == 3
    assert physical.physical_trends(df).count() == 1
    assert values(physical.hazard_rollup(df), "hazard") == [("Heat",)]


def test_nested_hazards(spark):
    df = phys(spark, {"indicator": "x", "indicatorRating": "C", "indicatorValue": 2.0, "indicatorUnit": ""})
    row = physical.hazards(df).collect()[0]
    assert row["indicator_rating_counts"].asDict() == {**dict.fromkeys("ABCDEFG", 0), "C": 1}
    assert [w.asDict() for w in row["worst_indicators"]] == [{"indicator": "x", "value": 2.0, "unit": None, "rating": "C"}]


def impact(value, **more):
    return {"adjustedSubriskRevenueImpact": value, **more}


def test_transition_trend_first_tie_wins_and_subrisk_may_be_null(spark):
    df = trans(spark, impact(1.0), {**impact(5.0), "seq": 50}, impact(7.0, subrisk="X"), impact(7.0, subrisk="Y"))
    assert values(transition.transition_trends(df), "max_adjusted_subrisk_revenue_impact", "top_subrisk") == [(7.0, "X")]
    none = trans(spark, impact(None, subrisk="X"), impact(3.0, subrisk=None))
    assert values(transition.transition_trends(none), "max_adjusted_subrisk_revenue_impact", "top_subrisk") == [(3.0, None)]


def test_transition_trend_ignores_nan_and_minus_infinity(spark):
    df = trans(spark, impact(NAN, subrisk="X"), impact(-INF, subrisk="Y"))
    assert values(transition.transition_trends(df), "max_adjusted_subrisk_revenue_impact", "top_subrisk") == [(None, None)]


def test_peak_tie_goes_to_the_first_seen_subrisk(spark):
    df = trans(
        spark,
        impact(1.0, subrisk="Market_demand_shifts"),
        impact(9.0, subrisk="Direct_carbon_cost", timeHorizon="2035"),
        impact(9.0, subrisk="Market_demand_shifts", timeHorizon="2040"),
    )
    row = transition.flat_rankings(transition.scenario_rankings(df)).collect()[0]
    assert (row["peak_subrisk"], row["peak_impact"], row["peak_year"]) == ("Market_demand_shifts", 9.0, 2040)
    assert (row["direct_carbon_value"], row["direct_carbon_year"]) == (9.0, 2035)


def test_a_first_nan_peak_is_never_beaten_and_a_later_one_never_wins(spark):
    df = trans(spark, impact(NAN, subrisk="X"), impact(5.0, subrisk="X"), impact(5.0, subrisk="Y"), impact(NAN, subrisk="Y"))
    got = {r["subrisk"]: r["value"] for r in transition.subrisk_peaks(df).collect()}
    assert math.isnan(got["X"])
    assert got["Y"] == 5.0
    assert math.isnan(transition.scenario_rankings(df).collect()[0]["peak_impact"])


def test_scenario_without_peak_is_dropped(spark):
    df = trans(spark, impact(None), impact(2.0, subrisk=""))
    assert transition.scenario_rankings(df).count() == 0


def test_driver_tie_goes_by_horizon_and_plain_peak_by_file_order(spark):
    df = trans(spark, impact(4.0, timeHorizon="2035"), impact(4.0, timeHorizon="2030"))
    rankings = transition.scenario_rankings(df)
    assert values(rankings, "peak_year") == [(2035,)]
    by_driver = transition.rankings_for_driver(axes.subrisk_rows(df), rankings, "X")
    assert values(by_driver, "peak_year") == [(2030,)]


def test_driver_trend_keeps_unquantified_points(spark):
    df = trans(spark, impact(None, timeHorizon="2025"), impact(2.0, timeHorizon="2030"), impact(9.0, subrisk="Y"))
    rows = axes.subrisk_rows(df)
    trend = transition.driver_trend(transition.transition_trends(df), rows, "X")
    assert values(trend, "horizon", "impact", "driver") == [(2025, None, None), (2030, 2.0, "X")]
    assert values(transition.driver_trend(transition.transition_trends(df), rows), "horizon", "impact") == [(2025, None), (2030, 9.0)]


@pytest.mark.parametrize("parts", [1, 7])
def test_results_do_not_depend_on_partitioning(spark, parts):
    rows = [
        {"indicator": f"i{i % 5}", "indicatorRating": "ABBA"[i % 4], "indicatorValue": float(i % 3), "adjustedTotalDamage": float(i)}
        for i in range(60)
    ]
    df = phys(spark, *rows)
    shuffled = df.repartition(parts, "indicator")
    for operator in (physical.physical_trends, physical.worst_indicators, physical.hazard_rollup):
        assert values(operator(shuffled)) == values(operator(df))
    t = trans(spark, *[impact(float(i % 7), subrisk="XYZ"[i % 3], timeHorizon=str(2025 + i % 4)) for i in range(60)])
    for operator in (transition.transition_trends, transition.scenario_rankings, transition.subrisk_peaks):
        assert values(operator(t.repartition(parts, "subrisk"))) == values(operator(t))


def test_order_over_several_files(spark):
    df = phys(spark, {"source_file": "b", "seq": 0, "adjustedTotalDamage": 1.0}, {"source_file": "a", "seq": 9, "adjustedTotalDamage": 2.0})
    assert values(physical.physical_trends(df, ("source_file", "seq")), "adjusted_total_damage") == [(1.0,)]


# -- slices ------------------------------------------------------------------------


def test_default_slices(spark):
    df = phys(
        spark,
        {"scenario": "ssp2-4.5", "timeHorizon": "2050"},
        {"scenario": "ssp5-8.5", "timeHorizon": "2100"},
        {"assetName": "b", "scenario": "y", "timeHorizon": "2030"},
        {"assetName": "b", "scenario": "x", "timeHorizon": "2040"},
    )
    trends = physical.physical_trends(df)
    default = axes.default_physical_slice(trends)
    assert values(default, "asset_name", "scenario", "horizon") == [("a", "ssp5-8.5", 2100), ("b", "x", 2040)]
    kept = axes.keep_or_default(trends, 2030, default.select("asset_name", "horizon"), "horizon")
    assert values(kept, "asset_name", "horizon") == [("a", 2100), ("b", 2030)]


def test_slice_asset_falls_back_to_the_first(spark):
    table = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "asset_name string, v int")
    assets = table.where("asset_name IS NOT NULL").select("asset_name")
    assert values(axes.slice_asset(table, assets, "b"), "v") == [(1,)]
    assert values(axes.slice_asset(table, assets, "?"), "v") == [(2,)]
    assert values(axes.slice_asset(table, assets, "b", keep_unnamed=True), "v") == [(1,), (3,)]


# -- response and series -----------------------------------------------------------


def hazards(spark, *rows):
    fields = ["asset_name", "scenario", "horizon", "hazard", *physical.HAZARD_METRICS]
    base = {"asset_name": "a", "scenario": "s", "hazard": "Flood"}
    ddl = "asset_name string, scenario string, horizon int, hazard string, " + ", ".join(f"{m} double" for m in physical.HAZARD_METRICS)
    return spark.createDataFrame([tuple({**base, **r}.get(f) for f in fields) for r in rows], ddl)


def test_static_hazard_compares_twelve_digits(spark):
    col = "adjusted_hazard_value_impact"
    near = hazards(spark, {"horizon": 1, col: 0.1234567890123}, {"horizon": 2, col: 0.1234567890124})
    far = hazards(spark, {"horizon": 1, col: 0.12345678901}, {"horizon": 2, col: 0.12345678902})
    nulls = hazards(spark, {"horizon": 1, col: 1.0}, {"horizon": 2, col: None})
    assert [values(response.static_hazard(t), "is_static") for t in (near, far, nulls)] == [[(True,)], [(False,)], [(False,)]]


def test_flat_series(spark):
    col = "adjusted_hazard_damage"
    keys = ["asset_name", "hazard"]
    flat = hazards(spark, {"horizon": 1, col: 1.0}, {"horizon": 2, col: 1.0 + 5e-10}, {"horizon": 3, col: NAN})
    bent = hazards(spark, {"horizon": 1, col: 1.0}, {"horizon": 2, col: 1.1})
    one = hazards(spark, {"horizon": 1, col: 1.0})
    assert [values(response.is_flat(t, keys, col), "is_flat") for t in (flat, bent, one)] == [[(True,)], [(False,)], [(True,)]]


def indicators(spark, *rows):
    data = [("a", "s", h, "Flood", ind, v, unit, None, i) for i, (h, ind, v, unit) in enumerate(rows)]
    return spark.createDataFrame(
        data, "asset_name string, scenario string, horizon int, hazard string, indicator string, value double, unit string, rating string, seq long"
    )


def test_magnitude_response_falls_back_and_ranks(spark):
    h = hazards(spark, *[{"horizon": y, "adjusted_hazard_disruption": float(y)} for y in (1, 2, 3)], {"horizon": 4})
    ind = indicators(
        spark,
        *[(y, "vary", float(y), "m") for y in (1, 2, 3, 4)],
        *[(y, "same", 5.0, "m") for y in (1, 2, 3)],
        *[(y, "short", float(y), "m") for y in (1, 2)],
        *[(y, "vary", float(y % 2), None) for y in (1, 2, 3)],
    )
    got = response.magnitude_response(ind, h)
    assert values(got.select("indicator", "unit", "metric", "series_rank").distinct()) == [
        ("vary", "", "disruption", 2),
        ("vary", "m", "disruption", 1),
    ]
    assert values(got.where("unit = 'm'"), "x", "y") == [(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)]


def trends(spark, *points):
    return spark.createDataFrame([("a", "s", h, v) for h, v in points], "asset_name string, scenario string, horizon int, adjusted_total_value_impact double")


def test_change_is_null_next_to_zero_or_null(spark):
    assert values(series.change_from_first(trends(spark, (2025, 2.0), (2030, 3.0), (2035, 0.0), (2040, None))), "horizon", "change_pct") == [
        (2025, 0.0), (2030, 50.0), (2035, None), (2040, None),
    ]
    for first in (0.0, None):
        assert values(series.change_from_first(trends(spark, (2025, first), (2030, 3.0))), "change_pct") == [(None,), (None,)]


def test_bar_share_of_nothing_positive_is_zero(spark):
    t = trends(spark, (1, -1.0), (2, None))
    assert values(series.bar_share(t, ["asset_name"], "adjusted_total_value_impact"), "bar_share") == [(0.0,), (0.0,)]


def test_scaled_series_and_summary(spark):
    t = trends(spark, (2025, 1.0), (2030, 8.0), (2035, 4.5), (2040, None))
    assert values(series.scaled_series(t), "horizon", "level") == [(2025, 0), (2030, 7), (2035, 3), (2040, None)]
    row = series.trend_summary(t).collect()[0]
    assert (row["peak_horizon"], row["min_value"], row["first_value"], row["last_value"]) == (2030, 1.0, 1.0, None)
    assert values(series.horizon_delta(t), "horizon", "delta") == [(2025, None), (2030, 7.0), (2035, -3.5), (2040, None)]
