from __future__ import annotations

from conftest import rows

from tallyhouse.contracts import STATUS_RULE, marketplace_contracts
from tallyhouse.operators import integrity as I
from tallyhouse.operators import quality as Q


def test_composite_key_is_checked_as_a_unit(spark):
    items = spark.createDataFrame([("one", 1), ("one", 1), ("one", 2)], "order_id string, order_item_id int")
    row = Q.key_checks(spark, {"order_items": items}).first()
    assert row.primary_key == "order_id + order_item_id"
    assert (row.duplicate_key_rows, row.duplicate_key_occurrences, row.status) == (2, 1, "failed")


def test_null_keys_group_as_equal_and_fail(spark):
    items = spark.createDataFrame([("one", None), ("one", None), ("two", 1)], "order_id string, order_item_id int")
    row = Q.key_checks(spark, {"order_items": items}).first()
    assert (row.null_key_rows, row.duplicate_key_rows, row.duplicate_key_occurrences) == (2, 2, 1)
    empty = Q.key_checks(spark, {"order_items": items.limit(0)}).first()
    assert (empty.row_count, empty.status) == (0, "passed")


def test_orphans_are_counted_by_rows_and_keys(spark):
    tables = {
        "orders": spark.createDataFrame(
            [("o1", "lost"), ("o2", "lost"), ("o3", "c1"), ("o4", None)], "order_id string, customer_id string"
        ),
        "customers": spark.createDataFrame([("c1",), (None,)], "customer_id string"),
    }
    found = {r.relationship: r for r in Q.reference_checks(spark, tables).collect()}
    row = found["orders_to_customers"]
    assert (row.child_rows, row.null_child_keys, row.orphan_rows, row.distinct_orphan_keys) == (4, 1, 2, 1)
    assert (row.matched_non_null_percent, row.status) == (33.3333, "failed")
    assert found["items_to_orders"].status == "failed" and found["items_to_orders"].child_rows == 0


def test_loose_reference_is_for_review_and_may_be_null(spark):
    text = "product_category_name string"
    products = spark.createDataFrame([("a",), (None,)], text)
    names = spark.createDataFrame([("a",)], text)
    tables = {"products": products, "product_category_name_translation": names}
    status = {r.relationship: r.status for r in Q.reference_checks(spark, tables).collect()}
    assert status["products_to_category_translation"] == "passed"
    tables["products"] = spark.createDataFrame([("b",)], text)
    status = {r.relationship: r.status for r in Q.reference_checks(spark, tables).collect()}
    assert status["products_to_category_translation"] == "review"


def test_reversed_timestamps_are_for_review(spark):
    orders = spark.createDataFrame(
        [("delivered", "2024-01-02", "2024-01-01"), ("delivered", "bad", "2024-01-01")],
        "order_status string, order_purchase_timestamp string, order_approved_at string",
    )
    found = {r.rule_name: r for r in Q.business_rule_checks(spark, {"orders": orders}).collect()}
    row = found["purchase_before_approval"]
    assert (row.comparable_rows, row.violation_rows, row.violation_percent, row.status) == (1, 1, 100.0, "review")
    assert set(found) == {"allowed_order_status", "purchase_before_approval"}


def test_allowed_values_count_over_all_rows(spark):
    orders = spark.createDataFrame([("delivered",), (None,), ("zz",), ("aa",)], "order_status string")
    row = Q.allowed_value_check(orders, STATUS_RULE).first()
    assert (row.comparable_rows, row.violation_rows, row.violation_percent) == (3, 2, 50.0)
    assert (row.details, row.status) == ("2 distinct values, listed by disallowed_values", "failed")


def test_very_many_bad_values_are_counted_and_all_listed(spark):
    orders = spark.range(1500).selectExpr("concat('s', id) AS order_status")
    row = Q.allowed_value_check(orders, STATUS_RULE).first()
    assert row.details.startswith("1500 distinct values")
    assert Q.disallowed_values(orders, STATUS_RULE).count() == 1500


def test_schema_differences(spark):
    contracts = marketplace_contracts(prefix="shop_", suffix="_dataset")
    sellers = spark.createDataFrame([("s", 1, "c", "XX", 0)],
                                    "seller_id string, seller_zip_code_prefix int, seller_city string, "
                                    "seller_state string, extra int")
    customers = spark.createDataFrame([("c",)], "customer_id string")
    report = Q.schema_checks(spark, {"sellers": sellers, "customers": customers}, contracts)
    found = {r.file_name: r for r in report.collect()}
    assert found["shop_sellers_dataset.csv"].status == "review"
    assert found["shop_sellers_dataset.csv"].unexpected_columns == "extra"
    assert found["shop_customers_dataset.csv"].status == "failed"
    assert found["shop_orders_dataset.csv"].missing_columns == "ALL — source file missing"
    assert "product_category_name_translation.csv" in found


def test_integrity_counts_null_keys_as_orphans(spark):
    orders = spark.createDataFrame([("a",), (None,), ("x",), ("x",)], "customer_id string")
    customers = spark.createDataFrame([("a",), ("a",), (None,)], "customer_id string")
    names = ["orders_without_customer", "customers_duplicate_pk"]
    count = lambda child, parent: {
        r.check_name: r.violation_count for r in I.key_rule_counts({"orders": child, "customers": parent}, names).collect()
    }
    assert count(orders, customers) == {"orders_without_customer": 3, "customers_duplicate_pk": 1}
    assert count(orders.limit(0), customers) == {"orders_without_customer": 0, "customers_duplicate_pk": 1}
    assert count(orders.filter("customer_id = 'a'"), customers.limit(0)) == {"orders_without_customer": 1, "customers_duplicate_pk": 0}
