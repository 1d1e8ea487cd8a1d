"""What the analyses of a run read from the stages stored before them."""

from __future__ import annotations

import re

from tallyhouse.operators import analyses as A
from tallyhouse.plans.analytics import share_stages
from tallyhouse.sources.testbed import Testbed

FOLDER = "/root/testdata/sf0.001"


def shuffled_columns(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [name for part in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) for name in re.findall(r"([a-z_]+)#", part)]


def test_no_analysis_of_a_run_joins_lines_or_reviews_with_orders_again(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shared = share_stages(spark, Testbed(spark, FOLDER).marketplace(), str(tmp_path))
        found = {name: shuffled_columns(A.ANALYSES[name](shared)) for name in A.ANALYSES}
        lines = shared["delivered_lines"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "order_id" not in found["seller_scorecard"] and "order_id" not in found["executive_summary"]
    assert "order_id" not in found["delivery_review_relationship"]
    assert found["category_performance"].count("order_id") == 1  # by category and order
    assert lines.where("first_of_seller").count() == lines.select("order_id", "seller_id").distinct().count() > 0


def test_stored_stages_do_not_change_a_result(spark, tmp_path):
    """Also where an order has the lines of a seller twice, no items, no review or an unknown seller."""
    stamp = "timestamp_ntz'2017-01-0{} 10:00:00'"
    orders = spark.createDataFrame(
        [("o1", "c1", "delivered"), ("o2", "c1", "delivered"), ("o3", "c2", "shipped"), ("o4", "c3", "delivered"), ("o5", "c4", "canceled")],
        "order_id string, customer_id string, order_status string",
    ).selectExpr(
        "*",
        f"{stamp.format(1)} AS order_purchase_timestamp",
        f"if(order_id <> 'o4', {stamp.format(5)}, null) AS order_delivered_customer_date",
        f"if(order_id = 'o2', {stamp.format(3)}, {stamp.format(6)}) AS order_estimated_delivery_date",
    )
    items = spark.createDataFrame(
        [("o1", 1, "p1", "s1", "1.10", "0.5"), ("o1", 2, "p1", "s1", "2.20", "0.5"), ("o1", 3, "p2", "s1", "3.30", None), ("o1", 4, "p2", "s2", "4", "1"),
         ("o2", 1, "p3", "s1", "5", "1"), ("o2", 2, None, None, "6", "1"), ("o3", 1, "p1", "s3", "7", "1")],
        "order_id string, order_item_id int, product_id string, seller_id string, p string, f string",
    ).selectExpr("order_id", "order_item_id", "product_id", "seller_id", "CAST(p AS decimal(14,2)) AS price", "CAST(f AS decimal(14,2)) AS freight_value")
    tables = {
        "orders": orders,
        "order_items": items,
        "order_reviews": spark.createDataFrame([("o1", 2), ("o1", 1), ("o3", 5)], "order_id string, review_score int"),
        "order_payments": spark.createDataFrame([("o1", "boleto", 1, 3)], "order_id string, payment_type string, payment_installments int, v int").selectExpr(
            "order_id", "payment_type", "payment_installments", "CAST(v AS decimal(14,2)) AS payment_value"
        ),
        "customers": spark.createDataFrame([(f"c{i}", f"u{i % 2}", "SP") for i in range(1, 5)], "customer_id string, customer_unique_id string, customer_state string"),
        "products": spark.createDataFrame([("p1", "a"), ("p2", "a"), ("p3", "b")], "product_id string, product_category_name_english string"),
        "sellers": spark.createDataFrame([("s1", "SP"), ("s2", "RJ")], "seller_id string, seller_state string"),
    }
    shared = share_stages(spark, tables, str(tmp_path))
    for name, analysis in A.ANALYSES.items():
        alone, stored = analysis(tables), analysis(shared)
        assert stored.schema == alone.schema, name
        assert stored.collect() == alone.collect(), name
