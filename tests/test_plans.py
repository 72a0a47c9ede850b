"""Physical plans: what reaches the scan, what is pruned before a shuffle, what must not appear."""

import os

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from martkit.operators import dedupe, marts
from martkit.sources.feed import province_table

FOLDER = os.environ.get("MARTKIT_TEST_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("name", [
    "daily_moving_avg", "clean_dedupe_first", "region_mart", "fact_rollup_5d", "fact_rollup_4d", "share_of_status", "summary_record",
    "quality_report", "star_measures_by_year", "slicer_years", "canonical_applied", "event_fact", "case_clean", "entity_rank",
])
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _plan(queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = _plan(queries()["filters_param"](spark, FOLDER))
    assert "EqualTo(o_orderstatus,F)" in plan and "GreaterThanOrEqual(o_totalprice,250000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz>" in _plan(queries()["daily_moving_avg"](spark, FOLDER))


def test_keep_first_prunes_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = _plan(dedupe.keep_first(df, ["k"], ["id"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_hot_key_without_loss(spark):
    """A third of the rows share one key; nothing is dropped and the join still finds them all."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    spelled = df.select("id", F.when(F.col("k") == -1, F.when(F.col("id") % 2 == 0, "HOT").otherwise("hot")).otherwise(F.col("k").cast("string")).alias("label"))
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        applied = dedupe.apply_canonical(spelled, "label")
        assert applied.count() == 30_000 and applied.where("label = 'HOT'").count() == 10_000
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert dedupe.keep_first(df, ["k"], ["id"]).count() == 20_001
    assert marts.duplicate_keys(df, ["k"]).first().n == 10_000


def test_province_table(spark):
    assert {r.slug: r.lat for r in province_table(spark).collect()}["phuket"] == 7.8804


@needs_tables
def test_slicer_prunes_the_stored_fact(spark):
    df = queries()["slicer_stored"](spark, FOLDER)
    df.collect()
    plan = _plan(df)
    assert "dynamicpruningexpression(month" in plan and "PartitionFilters: [isnotnull(month" in plan
