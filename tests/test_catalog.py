import pytest

from check import database, differences
from onomast.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_agrees_with_sql(spark, db, key):
    assert key in ORACLES
    assert differences(spark, db, FOLDER, key) is None


PYTHON = {"scan_tagged_sheets", "build_names_base", "enrich_calls"}
WRITING = {k for k in QUERIES if k.startswith(("scan_", "sink_", "us_")) or k in ("path_derived_column", *PYTHON)}


@pytest.mark.parametrize("key", sorted(set(QUERIES) - WRITING))
def test_plans_stay_in_the_jvm_and_join_on_keys(spark, key):
    plan = QUERIES[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


KEYED = ["process_names", "share_of_group", "rank_in_group_ranges", "sample_n", "shuffle_all", "lookup_estimate", "join_requested", "last_wins_map"]


@pytest.mark.parametrize("partitions", [1, 200])
@pytest.mark.parametrize("key", KEYED)
def test_results_do_not_depend_on_partitions(spark, db, key, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert differences(spark, db, FOLDER, key) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_filters_and_columns_reach_the_scan(spark):
    def plan(key):
        return QUERIES[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()

    top = plan("top_k")
    assert "LessThan(o_totalprice,400000.0)" in top and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in top
    equal = plan("filter_eq")
    assert "EqualTo(l_returnflag,R), EqualTo(l_linestatus,F)" in equal and "l_extendedprice" not in equal


def test_small_sides_are_broadcast(spark):
    for key in ("share_of_group", "join_group_total", "lookup_default", "estimate_regions", "join_requested"):
        plan = QUERIES[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, key
