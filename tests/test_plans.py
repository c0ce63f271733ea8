"""Physical-plan properties of registered queries."""

import os
import re

import pytest

import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_pass_mart_has_no_fact_to_fact_join(spark):
    plan = executed(catalog.arrivals_by_city_one_pass(spark, SF))
    joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[([^\]]*)\]", plan)
    assert joins and not any("cicid" in keys for _, keys in joins)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_stored_path_joins_facts_on_cicid_and_period(spark):
    plan = executed(catalog.arrivals_by_city_joined(spark, SF))
    joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[([^\]]*)\], \[([^\]]*)\]", plan)
    assert any("cicid" in left and "i94dt" in left for _, left, _ in joins)


def test_conform_lookups_are_broadcast(spark):
    plan = executed(catalog.conform(spark, SF))
    lookups = re.findall(r"BroadcastHashJoin \[[^\]]*\], \[[^\]]*__lookup_key", plan)
    assert len(lookups) == 5  # mode, visa, state, residence and birth country
    assert not re.search(r"SortMergeJoin \[[^\]]*\], \[[^\]]*__lookup_key", plan)


def test_mode_filter_reaches_the_dimension_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # show scan filters unabbreviated
    try:
        plan = executed(catalog.mode_filter(spark, SF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    dim_scan = [l for l in plan.splitlines() if "FileScan parquet" in l and "[o_orderpriority" in l]
    assert dim_scan and "URGENT" in dim_scan[0]


def test_equality_filter_is_pushed_and_columns_pruned(spark):
    plan = executed(catalog.equality_filter(spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in plan


def test_period_read_prunes_partitions(spark):
    plan = executed(catalog.period_pruned_read(spark, SF))
    assert re.search(r"PartitionFilters: \[[^\]]*i94dt", plan)


def test_reports_aggregate_map_side(spark):
    plan = executed(catalog.r1(spark, SF))
    assert re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_count", plan)
