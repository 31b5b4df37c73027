"""Result sets grown by imports against those built from all rows at once."""

import random

import pytest
from pyspark.sql import functions as F

from hazardlens.operators.quality import ImportFailure
from hazardlens.plans import incremental, result_build
from hazardlens.sinks.history import History

from build import physical as phys
from build import transition as trans
from build import values
from test_files import manifest_for

NAMES = ["is_p_" + c * 32 for c in "abc"]
NUMBERS = [None, 1.0, 2.0, 2.0, -1.0, float("nan"), float("-inf")]
RATINGS = ["A", "G", " a", "NA", "", None, "C"]


def some_rows(rng, n):
    common = lambda: {
        "assetName": rng.choice([*NAMES, ""]),
        "assetId": rng.choice("xyz"),
        "scenario": rng.choice(["s", "t"]),
        "timeHorizon": rng.choice(["2025", "2030", "Historical"]),
        "source_file": rng.choice("pq"),
        "indicator": rng.choice("ij"),
        "indicatorValue": rng.choice(NUMBERS),
    }
    number = lambda *names: {c: rng.choice(NUMBERS) for c in names}
    rating = lambda *names: {c: rng.choice(RATINGS) for c in names}
    physical_rows = [
        {
            **common(),
            "hazard": rng.choice(["Flood", "Heat", ""]),
            **number("adjustedTotalDamage", "adjustedTotalValueImpact", "adjustedHazardDamage", "adjustedHazardValueImpact"),
            **rating("indicatorRating", "HazardRating", "adjustedHazardExposureRating", "physicalExposureRating"),
        }
        for _ in range(n)
    ]
    transition_rows = [
        {
            **common(),
            "subrisk": rng.choice(["Direct_carbon_cost", "Market_demand_shifts", "X", ""]),
            **number("adjustedSubriskRevenueImpact"),
            **rating("adjustedSubriskExposureRating", "transitionExposureRating"),
        }
        for _ in range(n)
    ]
    return physical_rows, transition_rows


def plain(df):
    return [tuple(repr(x) for x in row) for row in values(df.select(*sorted(df.columns)))]


@pytest.mark.parametrize("seed", range(2))
def test_grown_tables_equal_those_of_all_rows(spark, tmp_path, seed):
    rng = random.Random(seed)
    imports = [(f"i{n}", f"2026-07-0{1 + n % 2}", phys(spark, *p), trans(spark, *t)) for n in range(3) for p, t in [some_rows(rng, 120)]]
    history = History(spark, str(tmp_path))
    manifest = manifest_for(spark, *NAMES[:2])
    for n, at in enumerate((2, 0, 1)):
        assert incremental.add_import(history, *imports[at]) == n
    assert incremental.add_import(history, *imports[0]) is None
    with pytest.raises(ImportFailure, match="i1 is in"):
        incremental.add_import(history, "i1", *imports[0][1:])

    def built(some):
        both = []
        for place in (2, 3):
            stamped = [i[place].withColumns({"import_id": F.lit(i[0]), "imported_at": F.lit(i[1])}) for i in some]
            out = stamped[0]
            for other in stamped[1:]:
                out = out.unionByName(other)
            both.append(out)
        return result_build.build_results(*both, manifest, incremental.PLACE)

    for version, some in ((None, imports), (0, [imports[2]])):
        want, got = built(some), incremental.results(history, manifest, version)
        for name in want.__dataclass_fields__:
            assert plain(getattr(got, name)) == plain(getattr(want, name)), name


def test_merging_reads_no_rows(spark, tmp_path):
    history = History(spark, str(tmp_path))
    for n in range(3):
        incremental.add_import(history, f"i{n}", "2026", phys(spark, *[{"indicatorValue": float(i)} for i in range(500)]), trans(spark, {}))
    assert history.read("state_trends").count() == 3 and history.read("state_worst").count() == 9
    res = incremental.results(history)
    assert values(res.hazards.select(F.transform("worst_indicators", lambda w: w["value"]))) == [([499.0, 499.0, 499.0],)]
    for table in (res.trends, res.hazards, res.rankings, res.assets):
        assert all("/data/state_" in file for file in table.inputFiles())
