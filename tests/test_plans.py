"""Plan shapes that must hold at any scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_points
from tallyhouse.operators import analyses as A
from tallyhouse.sources.testbed import Testbed

FOLDER = "/root/testdata/sf0.001"
CHECKED = [
    key
    for key in entry_points.queries()
    if key.startswith(("stg_", "ana_0", "ana_10", "con_03", "con_05", "chk_15", "cln_04", "cln_12", "cln_14", "ldc_15_all"))
]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", CHECKED)
def test_no_product_no_python_no_global_window(spark, key):
    plan = physical(entry_points.queries()[key](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan
    for window in re.findall(r"Window \[.*", plan):
        assert "], [" in window or "), [" in window, window
        assert ", []" not in window.split("AS", 1)[-1].split("],")[-2:][0], window


def test_scans_read_only_needed_columns_and_push_filters(spark):
    tables = Testbed(spark, FOLDER).marketplace()
    plan = physical(A.order_status_distribution(tables))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan
    seller = physical(A.seller_scorecard(tables))
    assert "o_totalprice" not in seller and "o_orderpriority" not in seller and "s_acctbal" not in seller


def test_order_joins_reuse_the_partitioning_of_their_aggregates(spark):
    """Orders, revenue and reviews meet on order_id with one shuffle each."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = Testbed(spark, FOLDER).marketplace()
        plan = physical(A._facts(tables))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = re.findall(r"Exchange hashpartitioning\(([^,]+)", plan)
    assert len(shuffles) == 3, plan


def test_forced_shuffle_joins_give_the_same_result(spark):
    tables = Testbed(spark, FOLDER).marketplace()
    usual = {name: analysis(tables).collect() for name, analysis in A.ANALYSES.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = Testbed(spark, FOLDER).marketplace()
        for name in ("executive_summary", "category_performance", "seller_scorecard", "monthly_customer_cohorts"):
            assert A.ANALYSES[name](again).collect() == usual[name]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
