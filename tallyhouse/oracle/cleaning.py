"""Expected results of cleaning and of the validation before publishing."""

from __future__ import annotations

from tallyhouse.contracts import (
    COORDINATE_COLUMNS,
    ID_LENGTH_COLUMNS,
    MARKETPLACE,
    ORDER_STATUSES,
    SEQUENCE_FLAGS,
    STATE_COLUMNS,
    TIMESTAMP,
    sql_list,
)
from tallyhouse.oracle.quality import union

LAYOUT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)?$"

CLEANED = {
    "product_categories": "cl_translation",
    "customers": "cl_customers",
    "products": "cl_products",
    "sellers": "cl_sellers",
    "geolocation_lookup": "cl_lookup",
    "geolocation_observations": "cl_geo",
    "orders": "cl_orders",
    "order_items": "cl_items",
    "order_payments": "cl_payments",
    "order_reviews": "cl_reviews",
}

RAW = {
    "customers": "raw_customers",
    "geolocation": "raw_geo",
    "orders": "raw_orders",
    "order_items": "raw_items",
    "order_payments": "raw_payments",
    "order_reviews": "raw_reviews",
    "products": "raw_products",
    "sellers": "raw_sellers",
    "product_category_name_translation": "raw_translation",
}


def text(column: str) -> str:
    return f"NULLIF(TRIM({column}, ' ' || chr(9) || chr(10) || chr(13)), '')"


def number(column: str) -> str:
    return f"TRY_CAST({text(column)} AS DOUBLE)"


def stamp(column: str) -> str:
    return f"CASE WHEN regexp_matches({text(column)}, '{LAYOUT}') THEN TRY_CAST({text(column)} AS TIMESTAMP) END"


def bad_stamp(column: str) -> str:
    return f"({text(column)} IS NOT NULL AND ({stamp(column)}) IS NULL)"


def columns(table: str, **replaced: str) -> str:
    """Select list that cleans the columns of a source table by their kinds."""
    parts = []
    for name, kind in MARKETPLACE.sources[table].columns.items():
        rule = text if kind == "text" else stamp if kind == TIMESTAMP else number
        parts.append(f"{replaced.get(name, rule(name))} AS {name.replace('_lenght', '_length')}")
    return ", ".join(parts)


def stamp_flags(table: str) -> str:
    return ", ".join(
        f"{bad_stamp(name)} AS dq_invalid_{name}"
        for name, kind in MARKETPLACE.sources[table].columns.items()
        if kind == TIMESTAMP
    )


SEQUENCES = ", ".join(f"COALESCE({a} > {b}, false) AS {flag}" for flag, (a, b) in SEQUENCE_FLAGS.items())
ANY_SEQUENCE = " OR ".join(f"COALESCE({a} > {b}, false)" for a, b in SEQUENCE_FLAGS.values())

TIMES = [c for c, kind in MARKETPLACE.sources["orders"].columns.items() if kind == TIMESTAMP]


def as_text(*names: str) -> str:
    """REPLACE list that turns timestamps and dates into text, as the registered queries do."""
    return "REPLACE (" + ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in names) + ")"


STAGE_VIEWS = {
    "cl_customers": f"SELECT {columns('customers')} FROM {{raw_customers}}",
    "cl_orders": f"""
        SELECT *, {SEQUENCES}, ({ANY_SEQUENCE}) AS dq_has_timestamp_sequence_issue
        FROM (SELECT {columns('orders', order_status=f"lower({text('order_status')})")}, {stamp_flags('orders')}
              FROM {{raw_orders}}) AS typed""",
    "cl_items": f"""
        SELECT *, COALESCE(price < 0, false) AS dq_negative_price,
               COALESCE(freight_value < 0, false) AS dq_negative_freight_value
        FROM (SELECT {columns('order_items')}, {stamp_flags('order_items')} FROM {{raw_items}}) AS typed""",
    "cl_payments": f"""
        SELECT *, COALESCE(payment_value < 0, false) AS dq_negative_payment_value,
               COALESCE(payment_installments < 0, false) AS dq_negative_payment_installments
        FROM (SELECT {columns('order_payments', payment_type=f"lower({text('payment_type')})")}
              FROM {{raw_payments}}) AS typed""",
    "cl_reviews": f"""
        SELECT *, (review_score IS NULL OR review_score NOT BETWEEN 1 AND 5) AS dq_review_score_out_of_range
        FROM (SELECT {columns('order_reviews')}, {stamp_flags('order_reviews')} FROM {{raw_reviews}}) AS typed""",
    "cl_names": f"SELECT {columns('product_category_name_translation')} FROM {{raw_translation}}",
    "cl_products": f"""
        SELECT p.*, p.product_category_name IS NULL AS dq_category_missing,
               p.product_category_name IS NOT NULL AND t.product_category_name_english IS NULL
                   AS dq_category_translation_missing,
               COALESCE(t.product_category_name_english, p.product_category_name, 'unknown')
                   AS product_category_name_english
        FROM (SELECT {columns('products')} FROM {{raw_products}}) AS p
        LEFT JOIN {{cl_names}} AS t ON t.product_category_name = p.product_category_name""",
    "cl_sellers": f"SELECT {columns('sellers')} FROM {{raw_sellers}}",
    "cl_translation": """
        SELECT *, false AS dq_translation_missing FROM {cl_names}
        UNION ALL SELECT DISTINCT product_category_name, product_category_name, true FROM {cl_products}
        WHERE product_category_name IS NOT NULL
          AND product_category_name NOT IN (SELECT product_category_name FROM {cl_names})""",
    "cl_geo": f"SELECT DISTINCT {columns('geolocation')} FROM {{raw_geo}}",
    "cl_lookup": """
        SELECT z.geolocation_zip_code_prefix AS zip_code_prefix, z.latitude, z.longitude,
               z.unique_observation_count, z.city_variant_count, z.state_variant_count, p.city, p.state,
               s.source_observation_count, z.state_variant_count > 1 AS dq_multiple_state_codes
        FROM (SELECT geolocation_zip_code_prefix, MEDIAN(geolocation_lat) AS latitude,
                     MEDIAN(geolocation_lng) AS longitude, COUNT(*) AS unique_observation_count,
                     COUNT(DISTINCT geolocation_city) AS city_variant_count,
                     COUNT(DISTINCT geolocation_state) AS state_variant_count
              FROM {cl_geo} GROUP BY 1) AS z
        JOIN (SELECT geolocation_zip_code_prefix, city, state
              FROM (SELECT geolocation_zip_code_prefix, geolocation_city AS city, geolocation_state AS state,
                           row_number() OVER (PARTITION BY geolocation_zip_code_prefix
                               ORDER BY n DESC, geolocation_state NULLS LAST, geolocation_city NULLS LAST) AS place
                    FROM (SELECT geolocation_zip_code_prefix, geolocation_city, geolocation_state, COUNT(*) AS n
                          FROM {cl_geo} GROUP BY ALL) AS pairs) AS ranked
              WHERE place = 1) AS p
          ON p.geolocation_zip_code_prefix = z.geolocation_zip_code_prefix
        JOIN (SELECT CAST(geolocation_zip_code_prefix AS DOUBLE) AS zip, COUNT(*) AS source_observation_count
              FROM {raw_geo} GROUP BY 1) AS s ON s.zip = z.geolocation_zip_code_prefix""",
}


def check(name: str, table: str, condition: str) -> str:
    return f"""
        SELECT '{name}' AS check_name, 'marketplace.{table}' AS table_name,
               COUNT(*) FILTER (WHERE {condition}) AS violation_count,
               CASE WHEN COUNT(*) FILTER (WHERE {condition}) = 0 THEN 'passed' ELSE 'failed' END AS status
        FROM {{{CLEANED[table]}}}"""


NOT_NULL = [
    check(f"{table.name}.{column}.not_null", table.name, f"{column} IS NULL")
    for table in MARKETPLACE.model.values()
    for column in table.mandatory
]
MAX_LENGTH = [check(f"{t}.{c}.max_length_32", t, f"length(CAST({c} AS VARCHAR)) > 32") for t, c in ID_LENGTH_COLUMNS]
STATE_LENGTH = [check(f"{t}.{c}.length_2", t, f"length(CAST({c} AS VARCHAR)) <> 2") for t, c in STATE_COLUMNS]
STATUSES = [
    check(
        "orders.order_status.allowed_values",
        "orders",
        f"order_status IS NULL OR order_status NOT IN ({sql_list(ORDER_STATUSES)})",
    )
]
AMOUNTS = [check(f"order_items.{c}.nonnegative", "order_items", f"{c} < 0") for c in ("price", "freight_value")]
PAYMENTS = [
    check(f"order_payments.{c}.nonnegative", "order_payments", f"{c} < 0")
    for c in ("payment_value", "payment_installments")
]
SCORES = [
    check(
        "order_reviews.review_score.between_1_and_5",
        "order_reviews",
        "review_score IS NULL OR review_score < 1 OR review_score > 5",
    )
]
COORDINATES = [
    check(
        f"{t}.coordinate_bounds",
        t,
        f"{a} IS NULL OR {o} IS NULL OR {a} NOT BETWEEN -90 AND 90 OR {o} NOT BETWEEN -180 AND 180",
    )
    for t, a, o in COORDINATE_COLUMNS
]


def unique(table, label: str) -> str:
    names = table.key or table.unique
    any_null = " OR ".join(f"{c} IS NULL" for c in names) if table.key else "false"
    return f"""
        SELECT '{table.name}.{label}.unique' AS check_name, 'marketplace.{table.name}' AS table_name,
               CAST(SUM(n - 1) + COALESCE(SUM(n) FILTER (WHERE {any_null}), 0) AS BIGINT) AS violation_count,
               CASE WHEN SUM(n - 1) + COALESCE(SUM(n) FILTER (WHERE {any_null}), 0) = 0
                    THEN 'passed' ELSE 'failed' END AS status
        FROM (SELECT {", ".join(names)}, COUNT(*) AS n FROM {{{CLEANED[table.name]}}} GROUP BY ALL) AS g"""


UNIQUE = [unique(t, "_".join(t.key) if t.key else "observation") for t in MARKETPLACE.model.values()]


def reference(rule) -> str:
    lost = (
        f"{rule.column} IS NOT NULL AND {rule.column} NOT IN (SELECT {rule.column} "
        f"FROM {{{CLEANED[rule.parent]}}} WHERE {rule.column} IS NOT NULL)"
    )
    return f"""
        SELECT '{rule.name}' AS check_name, 'marketplace.{rule.child}' AS table_name, COUNT(*) AS violation_count,
               CASE WHEN COUNT(*) = 0 THEN 'passed' ELSE 'failed' END AS status
        FROM {{{CLEANED[rule.child]}}} WHERE {lost}"""


REFERENCES = [reference(rule) for rule in MARKETPLACE.model_references]

DECLARED = [
    check(
        "products.nonnegative_dimensions.check",
        "products",
        "LEAST(product_weight_g, product_length_cm, product_height_cm, product_width_cm, product_photos_qty) < 0",
    ),
    check("orders.order_status.check", "orders", f"order_status NOT IN ({sql_list(ORDER_STATUSES)})"),
    check("order_items.amounts.check", "order_items", "LEAST(price, freight_value) < 0"),
    check("order_payments.values.check", "order_payments", "LEAST(payment_value, payment_installments) < 0"),
    check("order_reviews.review_score.check", "order_reviews", "review_score NOT BETWEEN 1 AND 5"),
    *[
        check(f"{t}.coordinates.check", t, f"{a} NOT BETWEEN -90 AND 90 OR {o} NOT BETWEEN -180 AND 180")
        for t, a, o in COORDINATE_COLUMNS
    ],
]


def type_check(view: str, column: str, kind: str) -> str:
    if kind == TIMESTAMP:
        invalid = f"{column} IS NOT NULL AND ({stamp(column)}) IS NULL"
        broken = "false"
    else:
        invalid = f"{column} IS NOT NULL AND TRY_CAST({column} AS DOUBLE) IS NULL"
        broken = f"TRY_CAST({column} AS DOUBLE) <> floor(TRY_CAST({column} AS DOUBLE))"
    return f"""
        SELECT '{column}' AS column_name, '{kind}' AS kind, COUNT(*) FILTER (WHERE {invalid}) AS invalid_values,
               COUNT(*) FILTER (WHERE {broken}) AS non_integral_values FROM {{{view}}}"""


def rows(view: str) -> str:
    return f"(SELECT COUNT(*) FROM {{{view}}})"


SUMMARY = union(
    f"SELECT '{t.source}.csv' AS file_name, 'marketplace.{t.name}' AS table_name, COUNT(*) AS row_count, "
    f"CAST({len(t.columns)} AS BIGINT) AS column_count, 'passed' AS status FROM {{{CLEANED[t.name]}}}"
    for t in MARKETPLACE.model.values()
)

DOMAINS = union([*NOT_NULL, *MAX_LENGTH, *STATE_LENGTH, *STATUSES, *AMOUNTS, *PAYMENTS, *SCORES, *COORDINATES])

STATEMENTS = {
    "cln_01_strip_text": f"""
        SELECT customer_id, customer_unique_id, {text('customer_zip_code_prefix')} AS customer_zip_code_prefix,
               {text('customer_city')} AS customer_city, {text('customer_state')} AS customer_state
        FROM {{raw_customers}}""",
    "cln_02_numeric_violations": union(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) "
        f"AS invalid_values FROM {{raw_items}}"
        for c in ("order_item_id", "price", "freight_value", "shipping_limit_date")
    ),
    "cln_02_coerce_numeric": f"""
        SELECT order_id, {number('order_item_id')} AS order_item_id, product_id, seller_id, shipping_limit_date,
               {number('price')} AS price, {number('freight_value')} AS freight_value FROM {{raw_items}}""",
    "cln_03_parse_timestamps": f"""
        SELECT order_id, {", ".join(f"CAST({stamp(c)} AS VARCHAR) AS {c}" for c in TIMES)}, {stamp_flags('orders')}
        FROM {{raw_orders}}""",
    "cln_04_sequence_flags": f"""
        SELECT order_id, {SEQUENCES}, ({ANY_SEQUENCE}) AS dq_has_timestamp_sequence_issue FROM {{mk_orders}}""",
    "cln_05_lower_values": f"""
        SELECT lower({text('order_status')}) AS order_status, COUNT(*) AS orders FROM {{raw_orders}} GROUP BY 1""",
    "cln_05_lower_payment_type": f"""
        SELECT lower({text('payment_type')}) AS payment_type, COUNT(*) AS payments FROM {{raw_payments}} GROUP BY 1""",
    "cln_06_item_flags": """
        SELECT dq_negative_price, dq_negative_freight_value, COUNT(*) AS items FROM {cl_items} GROUP BY ALL""",
    "cln_07_payment_flags": """
        SELECT dq_negative_payment_value, dq_negative_payment_installments, COUNT(*) AS payments
        FROM {cl_payments} GROUP BY ALL""",
    "cln_08_review_flag": """
        SELECT review_score, dq_review_score_out_of_range, COUNT(*) AS reviews FROM {cl_reviews} GROUP BY ALL""",
    "cln_09_translate_categories": """
        SELECT product_id, product_category_name, dq_category_missing, dq_category_translation_missing,
               product_category_name_english FROM {cl_products}""",
    "cln_10_correct_product_columns": """
        SELECT product_id, product_name_length, product_description_length FROM {cl_products}""",
    "cln_11_remove_exact_duplicates": "SELECT * FROM {cl_geo}",
    "cln_12_geolocation_lookup": "SELECT * FROM {cl_lookup}",
    "cln_13_promote_untranslated": "SELECT * FROM {cl_translation}",
    "cln_14_clean_customers": "SELECT * FROM {cl_customers}",
    "cln_14_clean_geolocation": "SELECT * FROM {cl_geo}",
    "cln_14_clean_orders": f"SELECT * {as_text(*TIMES)} FROM {{cl_orders}}",
    "cln_14_clean_order_items": f"SELECT * {as_text('shipping_limit_date')} FROM {{cl_items}}",
    "cln_14_clean_order_payments": "SELECT * FROM {cl_payments}",
    "cln_14_clean_order_reviews": f"""
        SELECT * {as_text('review_creation_date', 'review_answer_timestamp')} FROM {{cl_reviews}}""",
    "cln_14_clean_products": "SELECT * FROM {cl_products}",
    "cln_14_clean_sellers": "SELECT * FROM {cl_sellers}",
    "cln_14_clean_product_category_name_translation": "SELECT * FROM {cl_names}",
    "prf_14_flag_counts": union(
        f"SELECT '{f}' AS flag, COUNT(*) FILTER (WHERE {f}) AS true_rows FROM {{cl_orders}}"
        for f in [f"dq_invalid_{c}" for c in TIMES] + list(SEQUENCE_FLAGS) + ["dq_has_timestamp_sequence_issue"]
    ),
    "ldc_02_timestamp_violations": union(type_check("raw_orders", c, TIMESTAMP) for c in TIMES),
    "ldc_03_integer_violations": union(
        type_check("raw_integers", c, "integer")
        for c in ("payment_sequential", "payment_installments", "payment_value", "payment_type")
    ),
    "ldc_04_not_null": union(NOT_NULL),
    "ldc_05_max_length": union(MAX_LENGTH),
    "ldc_06_state_length": union(STATE_LENGTH),
    "ldc_07_allowed_statuses": union(STATUSES),
    "ldc_08_item_amounts": union(AMOUNTS),
    "ldc_09_payment_amounts": union(PAYMENTS),
    "ldc_10_review_score": union(SCORES),
    "ldc_11_coordinates": union(COORDINATES),
    "ldc_12_domain_report": DOMAINS,
    "ldc_13_uniqueness": union(UNIQUE),
    "ldc_14_foreign_keys": union(REFERENCES),
    "ldc_15_row_constraints": union(DECLARED),
    "ldc_15_all_declared": union([*UNIQUE, *REFERENCES, *DECLARED]),
    "val_01_processed_summary": f"""
        SELECT s.* REPLACE (CASE WHEN table_name IN (SELECT table_name FROM ({DOMAINS}) AS d WHERE status = 'failed')
                                 THEN 'failed' ELSE 'passed' END AS status)
        FROM ({SUMMARY}) AS s""",
}
