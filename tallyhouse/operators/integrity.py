"""Integrity checks on the published tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.rules import union_all, violation_counts
from tallyhouse.operators.key_index import KeyUse, key_facts, reference_use, rule_rows

Tables = Mapping[str, DataFrame]

# Check name -> (child table, child column, parent table); the parent column has the same name.
ORPHAN_CHECKS = {
    "orders_without_customer": ("orders", "customer_id", "customers"),
    "order_items_without_order": ("order_items", "order_id", "orders"),
    "order_items_without_product": ("order_items", "product_id", "products"),
    "order_items_without_seller": ("order_items", "seller_id", "sellers"),
    "payments_without_order": ("order_payments", "order_id", "orders"),
    "reviews_without_order": ("order_reviews", "order_id", "orders"),
}

# Check name -> (table, condition that is true on a counted row).
ROW_CHECKS = {
    "negative_item_amounts": ("order_items", "price < 0 OR freight_value < 0"),
    "negative_payment_values": ("order_payments", "payment_value < 0 OR payment_installments < 0"),
    "invalid_review_scores": ("order_reviews", "review_score NOT BETWEEN 1 AND 5"),
    "retained_order_timestamp_sequence_flags": ("orders", "dq_has_timestamp_sequence_issue"),
    "retained_missing_product_categories": ("products", "dq_category_missing"),
    "retained_fallback_category_translations": ("product_categories", "dq_translation_missing"),
}


# Rule -> (key use, violations in terms of its facts). A null key has no parent and counts as an orphan; a null category
# is allowed.
KEY_RULES = {"customers_duplicate_pk": (KeyUse("customers", ("customer_id",)), "duplicate_groups")}
KEY_RULES |= {
    name: (reference_use(child, column, parent, column), "orphan_rows + null_rows")
    for name, (child, column, parent) in ORPHAN_CHECKS.items()
}
KEY_RULES["products_without_category_dimension"] = (
    reference_use("products", "product_category_name", "product_categories", "product_category_name"),
    "orphan_rows",
)


def key_rule_counts(tables: Tables, names: Iterable[str] = KEY_RULES, facts: DataFrame | None = None) -> DataFrame:
    """(check_name, violation_count) of key rules, all from one shuffle of the keys, or from the facts of it."""
    rules = {name: KEY_RULES[name] for name in names}
    if facts is None:
        facts = key_facts(tables, [use for use, _ in rules.values()])
    return rule_rows(facts, rules).selectExpr("rule AS check_name", "counted AS violation_count")


def row_checks(tables: Tables, names: list[str] | None = None) -> DataFrame:
    """Row-level checks, one aggregate per table."""
    wanted = ROW_CHECKS if names is None else {name: ROW_CHECKS[name] for name in names}
    by_table: dict[str, dict[str, str]] = {}
    for name, (table, condition) in wanted.items():
        by_table.setdefault(table, {})[name] = condition
    return union_all(violation_counts(tables[table], rules) for table, rules in by_table.items())


def integrity_checks(tables: Tables, facts: DataFrame | None = None) -> DataFrame:
    """All fourteen checks with their status, most urgent wording last as the status sorts descending."""
    counted = [key_rule_counts(tables, facts=facts), row_checks(tables)]
    status = (
        F.when(F.col("check_name").like("retained_%"), "informational")
        .when(F.col("violation_count") == 0, "passed")
        .otherwise("failed")
    )
    return union_all(counted).withColumn("status", status).orderBy(F.desc("status"), "check_name")
