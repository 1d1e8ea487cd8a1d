"""Key and reference reports from one shared shuffle equal those that are computed singly."""

from __future__ import annotations

from tallyhouse.contracts import MARKETPLACE
from tallyhouse.operators import quality as Q


def _tables(spark, key_type="string"):
    return {
        "orders": spark.createDataFrame([("1", "a"), ("2", "b"), ("2", None), (None, "a")], "order_id string, customer_id string"),
        "customers": spark.createDataFrame([("a",), ("c",)], "customer_id string").selectExpr(f"cast(hex(customer_id) as {key_type}) AS customer_id" if key_type != "string" else "customer_id"),
        "order_items": spark.createDataFrame([("1", "1"), ("9", "1"), ("9", "2"), (None, "1")], "order_id string, order_item_id string"),
    }


def test_shared_facts_give_the_same_reports(spark):
    tables = _tables(spark)
    facts = Q.shared_key_facts(tables)
    assert facts is not None
    for check in (Q.key_checks, Q.reference_checks):
        alone, shared = check(spark, tables, MARKETPLACE), check(spark, tables, MARKETPLACE, facts)
        assert sorted(map(str, shared.collect())) == sorted(map(str, alone.collect()))
        assert "Union" not in shared._jdf.queryExecution().optimizedPlan().toString()


def test_keys_of_other_types_are_not_shared(spark):
    assert Q.shared_key_facts(_tables(spark, "bigint")) is None
