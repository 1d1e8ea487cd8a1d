"""Expected results of contract and integrity checks."""

from __future__ import annotations

from tallyhouse.contracts import MARKETPLACE, ORDER_STATUSES, sql_list

TYPED = {
    "customers": "pl_customers",
    "orders": "pl_orders",
    "order_items": "pl_items",
    "order_payments": "pl_payments",
    "order_reviews": "pl_reviews",
    "products": "mk_products",
    "sellers": "mk_sellers",
    "product_category_name_translation": "mk_categories",
}


def percent(top: str, bottom: str, empty: str = "0.0") -> str:
    share = f"CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0) * 100"
    return f"COALESCE(CAST(round_even(CAST({share} AS DECIMAL(28,12)), 4) AS DOUBLE), {empty})"


def key_check(name: str, view: str) -> str:
    table = MARKETPLACE.sources[name]
    keys = ", ".join(table.key)
    any_null = " OR ".join(f"{column} IS NULL" for column in table.key)
    return f"""
        SELECT '{table.file_name}' AS file_name, '{table.grain}' AS grain, '{" + ".join(table.key)}' AS primary_key,
               CAST(SUM(n) AS BIGINT) AS row_count,
               CAST(COALESCE(SUM(n) FILTER (WHERE {any_null}), 0) AS BIGINT) AS null_key_rows,
               CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_key_rows,
               CAST(SUM(n - 1) AS BIGINT) AS duplicate_key_occurrences,
               CASE WHEN MAX(n) > 1 OR COUNT(*) FILTER (WHERE {any_null}) > 0 THEN 'failed' ELSE 'passed' END AS status
        FROM (SELECT {keys}, COUNT(*) AS n FROM {{{view}}} GROUP BY {keys}) AS grouped"""


def reference_check(rule, views=TYPED) -> str:
    child, parent = views[rule.child], views[rule.parent]
    violated = "orphan_rows > 0" if rule.tolerant else "orphan_rows > 0 OR null_child_keys > 0"
    return f"""
        SELECT '{rule.name}' AS relationship,
               '{MARKETPLACE.file_name(rule.child)}:{rule.column}' AS child_reference,
               '{MARKETPLACE.file_name(rule.parent)}:{rule.column}' AS parent_reference,
               child_rows, null_child_keys, orphan_rows, distinct_orphan_keys,
               {percent("child_rows - null_child_keys - orphan_rows", "child_rows - null_child_keys", "100.0")}
                   AS matched_non_null_percent,
               CASE WHEN {violated} THEN '{"review" if rule.tolerant else "failed"}' ELSE 'passed' END AS status
        FROM (SELECT COUNT(*) AS child_rows, COUNT(*) FILTER (WHERE k IS NULL) AS null_child_keys,
                     COUNT(*) FILTER (WHERE lost) AS orphan_rows,
                     COUNT(DISTINCT k) FILTER (WHERE lost) AS distinct_orphan_keys
              FROM (SELECT {rule.column} AS k, {rule.column} IS NOT NULL AND {rule.column} NOT IN
                        (SELECT {rule.column} FROM {{{parent}}} WHERE {rule.column} IS NOT NULL) AS lost
                    FROM {{{child}}}) AS marked) AS counted"""


ALLOWED_CHECK = f"""
    SELECT 'allowed_order_status' AS rule_name, 'orders.csv' AS file_name, 'allowed_values' AS rule_type,
           COUNT(order_status) AS comparable_rows,
           COUNT(*) FILTER (WHERE order_status NOT IN ({sql_list(ORDER_STATUSES)})) AS violation_rows,
           {percent(f"COUNT(*) FILTER (WHERE order_status NOT IN ({sql_list(ORDER_STATUSES)}))", "COUNT(*)")}
               AS violation_percent,
           COUNT(DISTINCT order_status) FILTER (WHERE order_status NOT IN ({sql_list(ORDER_STATUSES)}))
               || ' distinct values, listed by disallowed_values' AS details,
           CASE WHEN COUNT(*) FILTER (WHERE order_status NOT IN ({sql_list(ORDER_STATUSES)})) > 0
                THEN 'failed' ELSE 'passed' END AS status
    FROM {{pl_orders}}"""


def time_order_check(rule) -> str:
    return f"""
        SELECT '{rule.name}' AS rule_name, '{MARKETPLACE.file_name(rule.table)}' AS file_name,
               'timestamp_order' AS rule_type,
               COUNT(*) FILTER (WHERE {rule.first.column} IS NOT NULL AND {rule.then.column} IS NOT NULL) AS comparable_rows,
               COUNT(*) FILTER (WHERE {rule.first.column} > {rule.then.column}) AS violation_rows,
               {percent(f"COUNT(*) FILTER (WHERE {rule.first.column} > {rule.then.column})",
                        f"COUNT(*) FILTER (WHERE {rule.first.column} IS NOT NULL AND {rule.then.column} IS NOT NULL)")}
                   AS violation_percent,
               '{rule.first.column} <= {rule.then.column}' AS details,
               CASE WHEN COUNT(*) FILTER (WHERE {rule.first.column} > {rule.then.column}) > 0 THEN 'review' ELSE 'passed' END
                   AS status
        FROM {{{TYPED[rule.table]}}}"""


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


KEY_CHECKS = union(key_check(name, view) for name, view in TYPED.items() if MARKETPLACE.sources[name].key)
REFERENCE_CHECKS = union(reference_check(rule) for rule in MARKETPLACE.references)
TIME_CHECKS = union(time_order_check(rule) for rule in MARKETPLACE.precedences)


def orphans(check: str, child: str, column: str, parent: str) -> str:
    return f"""
        SELECT '{check}' AS check_name, COUNT(*) AS violation_count
        FROM {{{child}}} AS c LEFT JOIN {{{parent}}} AS p ON p.{column} = c.{column} WHERE p.{column} IS NULL"""


def counted(check: str, view: str, condition: str) -> str:
    return f"SELECT '{check}' AS check_name, COUNT(*) AS violation_count FROM {{{view}}} WHERE {condition}"


CHECKS = {
    "chk_01_customers_duplicate_pk": """
        SELECT 'customers_duplicate_pk' AS check_name, COUNT(*) AS violation_count
        FROM (SELECT customer_id FROM {pb_customers} GROUP BY customer_id HAVING COUNT(*) > 1) AS d""",
    "chk_02_orders_without_customer": orphans("orders_without_customer", "pb_orders", "customer_id", "pb_customers"),
    "chk_03_order_items_without_order": orphans("order_items_without_order", "pb_items", "order_id", "pb_orders"),
    "chk_04_order_items_without_product": orphans(
        "order_items_without_product", "pb_items", "product_id", "pb_products"
    ),
    "chk_05_order_items_without_seller": orphans("order_items_without_seller", "pb_items", "seller_id", "pb_sellers"),
    "chk_06_payments_without_order": orphans("payments_without_order", "pb_payments", "order_id", "pb_orders"),
    "chk_07_reviews_without_order": orphans("reviews_without_order", "pb_reviews", "order_id", "pb_orders"),
    "chk_08_products_without_category_dimension": """
        SELECT 'products_without_category_dimension' AS check_name, COUNT(*) AS violation_count
        FROM {pb_products} AS p LEFT JOIN {pb_categories} AS c ON c.product_category_name = p.product_category_name
        WHERE p.product_category_name IS NOT NULL AND c.product_category_name IS NULL""",
    "chk_09_negative_item_amounts": counted("negative_item_amounts", "pb_items", "price < 0 OR freight_value < 0"),
    "chk_10_negative_payment_values": counted(
        "negative_payment_values", "pb_payments", "payment_value < 0 OR payment_installments < 0"
    ),
    "chk_11_invalid_review_scores": counted(
        "invalid_review_scores", "pb_reviews", "review_score NOT BETWEEN 1 AND 5"
    ),
    "chk_12_retained_order_timestamp_sequence_flags": counted(
        "retained_order_timestamp_sequence_flags", "pb_orders", "dq_has_timestamp_sequence_issue"
    ),
    "chk_13_retained_missing_product_categories": counted(
        "retained_missing_product_categories", "pb_products", "dq_category_missing"
    ),
    "chk_14_retained_fallback_category_translations": counted(
        "retained_fallback_category_translations", "pb_categories", "dq_translation_missing"
    ),
}

STAGE_VIEWS = {
    # Published tables with planted defects: rows are dropped from parents, keys nulled, values broken.
    "pb_customers": """
        SELECT * FROM {cl_customers} WHERE CAST(customer_id AS BIGINT) % 40 <> 0
        UNION ALL SELECT * FROM {cl_customers} WHERE CAST(customer_id AS BIGINT) % 71 = 0""",
    "pb_orders": """
        SELECT * REPLACE (CASE WHEN CAST(order_id AS BIGINT) % 211 = 0 THEN NULL ELSE customer_id END AS customer_id)
        FROM {cl_orders} WHERE CAST(order_id AS BIGINT) % 67 <> 0""",
    "pb_items": "SELECT * FROM {cl_items}",
    "pb_products": "SELECT * FROM {cl_products} WHERE CAST(product_id AS BIGINT) % 59 <> 0",
    "pb_sellers": "SELECT * FROM {cl_sellers} WHERE CAST(seller_id AS BIGINT) % 43 <> 0",
    "pb_payments": "SELECT * FROM {cl_payments}",
    "pb_reviews": "SELECT * FROM {cl_reviews}",
    "pb_categories": "SELECT * FROM {cl_translation} WHERE product_category_name <> 'economy'",
    "ch_all": union(CHECKS.values()),
    "ch_keys": KEY_CHECKS,
    "ch_references": REFERENCE_CHECKS,
    "ch_rules": f"{ALLOWED_CHECK}\nUNION ALL\n{TIME_CHECKS}",
    "ch_schema": """
        SELECT * FROM (VALUES
            ('customers.csv', 'failed', 'customer_state', '', 5, 4),
            ('geolocation.csv', 'review', '', 'note', 5, 6),
            ('orders.csv', 'passed', '', '', 8, 8),
            ('order_items.csv', 'passed', '', '', 7, 7),
            ('order_payments.csv', 'passed', '', '', 5, 5),
            ('order_reviews.csv', 'passed', '', '', 7, 7),
            ('products.csv', 'passed', '', '', 9, 9),
            ('sellers.csv', 'failed', 'ALL — source file missing', '', 4, 0),
            ('product_category_name_translation.csv', 'passed', '', '', 2, 2)
        ) AS t(file_name, status, missing_columns, unexpected_columns, expected_column_count, actual_column_count)""",
    "ch_bundle": """
        SELECT 'schema_checks' AS report, 'passed' AS status, CAST(9 AS BIGINT) AS checks
        UNION ALL SELECT 'key_checks', status, COUNT(*) FROM {ch_keys} GROUP BY status
        UNION ALL SELECT 'relationship_checks', status, COUNT(*) FROM {ch_references} GROUP BY status
        UNION ALL SELECT 'business_rule_checks', status, COUNT(*) FROM {ch_rules} GROUP BY status""",
}

STATEMENTS = {
    "con_02_key_checks": "SELECT * FROM {ch_keys}",
    "con_02_repeated_line_key": """
        SELECT CAST(SUM(n) AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS null_key_rows,
               CAST(SUM(n) FILTER (WHERE n > 1) AS BIGINT) AS duplicate_key_rows,
               CAST(SUM(n - 1) AS BIGINT) AS duplicate_key_occurrences
        FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) AS g""",
    "con_03_reference_checks": "SELECT * FROM {ch_references}",
    "con_04_allowed_values": ALLOWED_CHECK,
    "con_04_disallowed_values": f"""
        SELECT order_status AS bad_value, COUNT(*) AS violation_rows FROM {{pl_orders}}
        WHERE order_status NOT IN ({sql_list(ORDER_STATUSES)}) GROUP BY order_status""",
    "con_05_time_order": TIME_CHECKS,
    "con_06_report_bundle": "SELECT * FROM {ch_bundle}",
    **CHECKS,
    "chk_15_integrity_report": """
        SELECT check_name, violation_count,
               CASE WHEN check_name LIKE 'retained_%' THEN 'informational' WHEN violation_count = 0 THEN 'passed'
                    ELSE 'failed' END AS status
        FROM {ch_all}""",
}
