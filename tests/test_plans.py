"""Physical plan shapes that the scale design relies on."""

import re

from conftest import SF
from shopflow.plans.registry import QUERIES


def plan(spark, name, sf="0.01"):
    return QUERIES[name](spark, SF[sf])._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "insert_if_absent")
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p
    # the stored-keys side reads only what the keys need
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string,"
                     r"l_shipdate:timestamp_ntz>", p)


def test_top_products_aggregates_before_the_join(spark):
    p = plan(spark, "top_products")
    join = p.index("Join")
    # the product-level aggregate (partial + final) sits below the join
    assert "partial_sum(quantity" in p[join:]


def test_latest_by_key_aggregates_partially_before_the_shuffle(spark):
    p = plan(spark, "latest_by_key")
    ex = [m.start() for m in re.finditer(r"Exchange hashpartitioning\(session_id", p)]
    assert ex and "partial_max_by" in p[ex[0]:]


def test_merges_read_each_table_once(spark):
    for name, scans in (("upsert", 2), ("merge_additive", 1), ("distinct_users_incremental", 1), ("run_summary", 1),
                        ("insert_if_absent", 2), ("export_changes", 2)):
        assert plan(spark, name).count("FileScan parquet") == scans, name


def test_no_plan_forces_a_broadcast_or_spreads_a_scan(spark):
    for name in ("sales_daily", "upsert", "insert_if_absent"):
        p = QUERIES[name](spark, SF["0.01"])._jdf.queryExecution()
        assert "ResolvedHint" not in p.analyzed().toString() and "REPARTITION_BY_NUM" not in p.executedPlan().toString()


def test_funnel_is_one_pass(spark):
    p = plan(spark, "behavior_funnel_daily")
    assert p.count("FileScan parquet") == 1
