"""One key holds a third of the rows and more: results stay whole, plans stay safe."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from hazardlens.operators import axes, physical, runs, transition
from hazardlens.plans import driver_views
from hazardlens.plans.oracle import ORACLE
from hazardlens.plans.queries import QUERIES
from hazardlens.operators.joins import left_join_many, lookup_join, staged

from build import physical as phys
from build import values

SF = "/root/testdata/sf0.001"


def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(3000).select("id", key.alias("k"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_join_with_dealt_nulls_equals_plain_join(spark, how):
    left = skewed(spark)
    right = spark.createDataFrame([("hot", 1), ("k7", 2), ("k8", 3), ("none", 4)], "k string, v int")
    dealt = lookup_join(left, right, ["k"], how, spread="id")
    assert values(dealt, *left.columns) == values(left.join(right, "k", how), *left.columns)
    if how in ("left", "inner"):
        assert values(dealt, "id", "v") == values(left.join(right, "k", how), "id", "v")


@pytest.mark.parametrize("name", ["manifest_rows", "run_summary", "sidecar_priority", "join_back_rows", "scope_portfolio"])
def test_no_job_but_schema_reads_while_a_plan_is_built(spark, name):
    stages = []
    reader = spark.read.parquet

    def counted(*paths, **options):
        before = jobs()
        df = reader(*paths, **options)
        stages.append(jobs() - before)
        return df

    def jobs():
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("plan"))

    spark.sparkContext.setJobGroup("plan", name)
    before = jobs()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.read), "parquet", lambda self, *paths, **options: counted(*paths, **options))
        spark_entry.queries()[name](spark, SF)
    run = jobs() - before
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert run == sum(stages)


def test_join_back_reads_its_rows_once_and_only_what_it_needs(spark):
    text = plan(spark_entry.queries()["join_back_rows"](spark, SF))
    assert text.count("events.parquet") == 1 and "xxhash64" not in text


def test_staged_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, [("a", 2.0)]), (2, None)], "i int, x array<struct<n:string,v:double>>")
    again = staged(df)
    assert again.schema == df.schema and values(again) == values(df)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_cuts_every_partition_before_the_shuffle(spark):
    text = plan(physical.worst_indicators(phys(spark, {})))
    assert "row_number(), 3, Partial" in text


@pytest.mark.parametrize("operator", [physical.physical_trends, physical.hazard_rollup])
def test_roll_ups_combine_before_the_one_shuffle(spark, operator):
    text = plan(operator(phys(spark, {})))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_max" in text and "SortAggregate" not in text


def test_view_filter_reaches_the_scan(spark, tmp_path):
    trends = physical.physical_trends(phys(spark, {}))
    trends.write.parquet(str(tmp_path / "t"))
    again = axes.slice_view(spark.read.parquet(str(tmp_path / "t")), "s", 2030)
    text = plan(again.select("asset_name"))
    assert "EqualTo(horizon,2030)" in text and "adjusted_total_damage" not in text


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.count() > 0 and "is_static" in df.columns


def test_peaks_read_no_more_than_they_need(spark):
    from hazardlens.plans import driver_views

    text = plan(transition.subrisk_peaks(driver_views.transition(spark, SF)))
    assert "o_orderdate" not in text.split("ReadSchema")[-1]


def test_left_join_many_equals_left_join(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    many = spark.createDataFrame([("a", i) for i in range(20)] + [("z", 0), (None, 1)], "k string, w int")
    got = left_join_many(left, many, ["k"])
    assert values(got, "k", "v", "w") == values(left.join(many, "k", "left"), "k", "v", "w")


def test_null_keys_are_spread_without_a_count(spark):
    left = spark.range(200).select("id", F.lit(None).cast("string").alias("k"))
    right = spark.createDataFrame([("a", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(left, right, ["k"], spread="id")
        used = joined.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert joined.count() == 200 and used > 1


@pytest.mark.parametrize("name", ["manifest_file", "run_messages"])
def test_an_export_is_computed_once(spark, name):
    """The files of a run read rows that are computed once."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(price):
        seen.add(1)
        return price

    plain = driver_views.table

    def tapped(session, folder, table):
        df = plain(session, folder, table)
        return df.withColumn("o_totalprice", counted("o_totalprice")) if table == "orders" else df

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(driver_views, "table", tapped)
        QUERIES[name](spark, SF).collect()
    # the price is read by the sidecar rows alone
    assert seen.value == plain(spark, SF, "orders").count()


def test_batches_compute_their_rows_once(spark):
    """The pass that samples the order reads written rows."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(name):
        seen.add(1)
        return name

    rows = spark.range(50).select(counted(F.format_string("n%02d", "id")).alias("name"))
    got = runs.batch_uploads(rows, [F.col("name")], 20)
    assert values(got, "name", "row_number", "batch_id") == [(f"n{i:02d}", i + 1, i // 20) for i in range(50)]
    assert seen.value == 50


def test_workbooks_are_dealt_over_all_partitions(spark):
    """Blocks small in bytes are not merged into few tasks, as each costs much work."""
    packed = driver_views.pack_workbooks(driver_views.physical(spark, SF), rows_per_file=10)
    used = packed.select(F.spark_partition_id().alias("part"), "path").collect()
    assert len({r["path"] for r in used}) == len(used) == 100
    assert len({r["part"] for r in used}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
