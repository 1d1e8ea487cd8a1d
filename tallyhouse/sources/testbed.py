"""Marketplace tables derived from the star-schema test tables.

Each view is one SELECT that reads the same in Spark SQL and in DuckDB; ``{name}`` stands for a table or for
another view. The views carry planted defects so that every check has something to find.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.session import scratch_folder, size_shuffles
from tallyhouse.sources.sinks import discard, write_parquet

TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

_PURCHASE = "o_orderdate + (o_orderkey % 86400) * INTERVAL '1' SECOND"
_APPROVED = "CASE WHEN o_orderkey % 53 <> 0 THEN o_orderdate + (o_orderkey % 48) * INTERVAL '1' HOUR END"
_CARRIER = "CASE WHEN o_orderkey % 37 <> 0 THEN o_orderdate + ((o_orderkey * 3) % 5 - 1) * INTERVAL '1' DAY END"
_DELIVERED = (
    "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 41 <> 0 THEN o_orderdate "
    "+ ((o_orderkey * 7) % 30 + 1) * INTERVAL '1' DAY + ((o_orderkey * 13) % 86400) * INTERVAL '1' SECOND END"
)
_ESTIMATE = "o_orderdate + ((o_orderkey * 11) % 25 + 8) * INTERVAL '1' DAY"
_PRICE = "CAST(l_extendedprice AS DECIMAL(14,2))"
_FREIGHT = f"CAST({_PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(14,2))"

VIEWS = {
    # Clean, typed model.
    "mk_customers": """
        SELECT CAST(c_custkey AS STRING) AS customer_id,
               CAST(c_custkey - CASE WHEN c_custkey % 10 = 1 THEN 1 ELSE 0 END AS STRING) AS customer_unique_id,
               c_nationkey AS customer_zip_code_prefix, lower(c_mktsegment) AS customer_city,
               n_name AS customer_state
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "mk_orders": f"""
        SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
               CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
                    WHEN o_orderkey % 8 = 0 THEN 'canceled' ELSE 'processing' END AS order_status,
               {_PURCHASE} AS order_purchase_timestamp, {_APPROVED} AS order_approved_at,
               {_CARRIER} AS order_delivered_carrier_date, {_DELIVERED} AS order_delivered_customer_date,
               {_ESTIMATE} AS order_estimated_delivery_date
        FROM {{orders}}""",
    "mk_items": f"""
        SELECT CAST(l_orderkey AS STRING) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id,
               l_shipdate AS shipping_limit_date, {_PRICE} AS price, {_FREIGHT} AS freight_value
        FROM {{lineitem}}""",
    "mk_lines": """
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
            l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS seq
        FROM {lineitem}""",
    "mk_payments": f"""
        SELECT CAST(l_orderkey AS STRING) AS order_id, CAST(seq AS INT) AS payment_sequential,
               CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END AS payment_type,
               CAST(l_quantity AS INT) % 10 + 1 AS payment_installments, {_PRICE} AS payment_value
        FROM {{mk_lines}}""",
    "mk_reviews": """
        SELECT concat('r', CAST(l_orderkey AS STRING), '-', CAST(seq AS STRING)) AS review_id,
               CAST(l_orderkey AS STRING) AS order_id, CAST(l_quantity AS INT) % 5 + 1 AS review_score,
               CASE WHEN l_linenumber % 3 = 0 THEN concat('title ', l_returnflag) END AS review_comment_title,
               CASE WHEN l_linenumber % 2 = 0 THEN concat('message ', l_returnflag) END AS review_comment_message,
               l_shipdate AS review_creation_date,
               l_shipdate + (l_linenumber - 2) * INTERVAL '1' DAY AS review_answer_timestamp
        FROM {mk_lines}""",
    "mk_categories": """
        SELECT DISTINCT lower(p_type) AS product_category_name,
               concat('cat_', lower(p_type)) AS product_category_name_english
        FROM {part} WHERE p_type <> 'PROMO'""",
    "mk_products": """
        SELECT CAST(p_partkey AS STRING) AS product_id,
               CASE WHEN p_partkey % 31 <> 0 THEN lower(p_type) END AS product_category_name,
               length(p_name) AS product_name_lenght, length(p_name) * 3 AS product_description_lenght,
               CASE WHEN p_partkey % 17 <> 0 THEN p_size % 6 END AS product_photos_qty,
               p_size AS product_weight_g, p_size % 40 + 1 AS product_length_cm,
               p_size % 25 + 1 AS product_height_cm, p_size % 30 + 1 AS product_width_cm
        FROM {part}""",
    "mk_sellers": """
        SELECT CAST(s_suppkey AS STRING) AS seller_id, s_nationkey AS seller_zip_code_prefix,
               lower(s_name) AS seller_city, n_name AS seller_state
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "mk_geo": """
        SELECT c_nationkey AS geolocation_zip_code_prefix, CAST(c_custkey % 7 AS DOUBLE) - 30 AS geolocation_lat,
               CAST(c_custkey % 3 AS DOUBLE) - 50 AS geolocation_lng, lower(c_mktsegment) AS geolocation_city,
               CASE WHEN c_custkey % 50 = 0 THEN 'XX' ELSE substr(r_name, 1, 2) END AS geolocation_state
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # Products with their English category, as the analyses read them.
    "mk_model_products": """
        SELECT p.product_id, p.product_category_name,
               coalesce(c.product_category_name_english, p.product_category_name, 'unknown')
                   AS product_category_name_english
        FROM {mk_products} AS p LEFT JOIN {mk_categories} AS c
          ON p.product_category_name = c.product_category_name""",
    # Items with a unique key: repeated line numbers of an order are summed up.
    "mk_unique_items": f"""
        SELECT CAST(l_orderkey AS STRING) AS order_id, l_linenumber AS order_item_id,
               CAST(max(l_partkey) AS STRING) AS product_id, CAST(max(l_suppkey) AS STRING) AS seller_id,
               max(l_shipdate) AS shipping_limit_date, CAST(sum({_PRICE}) AS DECIMAL(14,2)) AS price,
               CAST(sum({_FREIGHT}) AS DECIMAL(14,2)) AS freight_value
        FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber""",
    # Planted defects.
    "pl_customers": "SELECT * FROM {mk_customers} WHERE CAST(customer_id AS BIGINT) % 40 <> 0",
    "pl_products": "SELECT * FROM {mk_products} WHERE CAST(product_id AS BIGINT) % 59 <> 0",
    "pl_sellers": "SELECT * FROM {mk_sellers} WHERE CAST(seller_id AS BIGINT) % 43 <> 0",
    "pl_items": """
        SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
               CASE WHEN CAST(order_id AS BIGINT) % 113 = 0 THEN -price ELSE price END AS price, freight_value
        FROM {mk_items}""",
    "pl_payments": """
        SELECT order_id, payment_sequential, payment_type,
               CASE WHEN CAST(order_id AS BIGINT) % 131 = 0 THEN -payment_installments
                    ELSE payment_installments END AS payment_installments,
               CASE WHEN CAST(order_id AS BIGINT) % 109 = 0 THEN -payment_value ELSE payment_value END
                   AS payment_value
        FROM {mk_payments}""",
    "pl_reviews": """
        SELECT review_id, order_id,
               CASE WHEN review_id LIKE '%-2' AND CAST(order_id AS BIGINT) % 127 = 0
                    THEN CASE WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN 0 END
                    ELSE review_score END AS review_score,
               review_comment_title, review_comment_message, review_creation_date, review_answer_timestamp
        FROM {mk_reviews}""",
    "pl_orders": """
        SELECT CASE WHEN CAST(order_id AS BIGINT) % 997 = 0 THEN NULL ELSE order_id END AS order_id,
               CASE WHEN CAST(order_id AS BIGINT) % 211 = 0 THEN NULL ELSE customer_id END AS customer_id,
               CASE WHEN CAST(order_id AS BIGINT) % 223 = 0 THEN NULL
                    WHEN CAST(order_id AS BIGINT) % 227 = 0 THEN 'lost'
                    WHEN CAST(order_id AS BIGINT) % 229 = 0 THEN 'Lost again' ELSE order_status END AS order_status,
               order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
               order_delivered_customer_date, order_estimated_delivery_date
        FROM {mk_orders}""",
    # The source files as dirty text.
    "raw_customers": """
        SELECT customer_id, customer_unique_id, concat(' ', CAST(customer_zip_code_prefix AS STRING))
                   AS customer_zip_code_prefix,
               CASE WHEN CAST(customer_id AS BIGINT) % 7 = 0 THEN concat('  ', customer_city, ' ')
                    ELSE customer_city END AS customer_city,
               CASE WHEN CAST(customer_id AS BIGINT) % 19 = 0 THEN '  ' ELSE customer_state END AS customer_state
        FROM {mk_customers}""",
    "raw_orders": f"""
        SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
               CASE WHEN o_orderkey % 11 = 0
                         THEN CASE WHEN o_orderstatus = 'F' THEN '  DELIVERED ' ELSE '  Shipped ' END
                    WHEN o_orderkey % 13 = 0 THEN '   ' WHEN o_orderkey % 101 = 0 THEN 'lost'
                    WHEN o_orderstatus = 'F' THEN 'delivered' ELSE 'shipped' END AS order_status,
               CASE WHEN o_orderkey % 97 = 0 THEN 'not-a-date' WHEN o_orderkey % 89 = 0 THEN ''
                    ELSE CAST({_PURCHASE} AS STRING) END AS order_purchase_timestamp,
               CAST({_APPROVED} AS STRING) AS order_approved_at,
               CAST({_CARRIER} AS STRING) AS order_delivered_carrier_date,
               CAST({_DELIVERED} AS STRING) AS order_delivered_customer_date,
               CAST({_ESTIMATE} AS STRING) AS order_estimated_delivery_date
        FROM {{orders}}""",
    "raw_items": """
        SELECT order_id, CAST(order_item_id AS STRING) AS order_item_id, product_id, seller_id,
               CASE WHEN CAST(order_id AS BIGINT) % 103 = 0 THEN '31/12/1997'
                    ELSE CAST(shipping_limit_date AS STRING) END AS shipping_limit_date,
               CAST(price AS STRING) AS price,
               CASE WHEN CAST(order_id AS BIGINT) % 107 = 0 THEN NULL ELSE CAST(freight_value AS STRING) END
                   AS freight_value
        FROM {pl_items}""",
    "raw_payments": """
        SELECT order_id, CAST(payment_sequential AS STRING) AS payment_sequential,
               CASE WHEN CAST(order_id AS BIGINT) % 5 = 0 THEN concat(' ', upper(payment_type))
                    ELSE payment_type END AS payment_type,
               CAST(payment_installments AS STRING) AS payment_installments,
               CAST(payment_value AS STRING) AS payment_value
        FROM {pl_payments}""",
    "raw_reviews": """
        SELECT review_id, order_id, CAST(review_score AS STRING) AS review_score,
               ' ' || review_comment_title AS review_comment_title,
               CASE WHEN review_comment_message = 'message R' THEN '   ' ELSE review_comment_message END
                   AS review_comment_message,
               CAST(review_creation_date AS STRING) AS review_creation_date,
               CASE WHEN CAST(order_id AS BIGINT) % 139 = 0 THEN 'soon'
                    ELSE CAST(review_answer_timestamp AS STRING) END AS review_answer_timestamp
        FROM {pl_reviews}""",
    "raw_products": """
        SELECT product_id,
               CASE WHEN CAST(product_id AS BIGINT) % 6 = 0 THEN product_category_name || '  '
                    ELSE product_category_name END AS product_category_name,
               CAST(product_name_lenght AS STRING) AS product_name_lenght,
               CAST(product_description_lenght AS STRING) AS product_description_lenght,
               CAST(product_photos_qty AS STRING) AS product_photos_qty,
               CAST(product_weight_g AS STRING) AS product_weight_g,
               CAST(product_length_cm AS STRING) AS product_length_cm,
               CAST(product_height_cm AS STRING) AS product_height_cm,
               CAST(product_width_cm AS STRING) AS product_width_cm
        FROM {mk_products}""",
    "raw_sellers": """
        SELECT seller_id, CAST(seller_zip_code_prefix AS STRING) AS seller_zip_code_prefix,
               concat(' ', seller_city) AS seller_city, seller_state
        FROM {mk_sellers}""",
    "raw_translation": """
        SELECT concat(' ', product_category_name) AS product_category_name,
               concat(product_category_name_english, ' ') AS product_category_name_english
        FROM {mk_categories}""",
    "raw_geo": """
        SELECT CAST(geolocation_zip_code_prefix AS STRING) AS geolocation_zip_code_prefix,
               CAST(CAST(geolocation_lat AS DECIMAL(9,4)) AS STRING) AS geolocation_lat,
               CAST(CAST(geolocation_lng AS DECIMAL(9,4)) AS STRING) AS geolocation_lng,
               concat(geolocation_city, ' ') AS geolocation_city, geolocation_state
        FROM {mk_geo}""",
    # Source files as text that pass every gate.
    "gd_customers": """
        SELECT customer_id, customer_unique_id, CAST(customer_zip_code_prefix AS STRING) AS customer_zip_code_prefix,
               concat(' ', customer_city) AS customer_city,
               concat('S', substr(customer_state, 1, 1)) AS customer_state
        FROM {mk_customers}""",
    "gd_orders": """
        SELECT order_id, customer_id, concat(' ', upper(order_status)) AS order_status,
               CAST(order_purchase_timestamp AS STRING) AS order_purchase_timestamp,
               CAST(order_approved_at AS STRING) AS order_approved_at,
               CAST(order_delivered_carrier_date AS STRING) AS order_delivered_carrier_date,
               CAST(order_delivered_customer_date AS STRING) AS order_delivered_customer_date,
               CAST(order_estimated_delivery_date AS STRING) AS order_estimated_delivery_date
        FROM {mk_orders}""",
    "gd_items": """
        SELECT order_id, CAST(order_item_id AS STRING) AS order_item_id, product_id, seller_id,
               CAST(shipping_limit_date AS STRING) AS shipping_limit_date, CAST(price AS STRING) AS price,
               CAST(freight_value AS STRING) AS freight_value
        FROM {mk_unique_items}""",
    "gd_payments": """
        SELECT order_id, CAST(payment_sequential AS STRING) AS payment_sequential, payment_type,
               CAST(payment_installments AS STRING) AS payment_installments,
               CAST(payment_value AS STRING) AS payment_value
        FROM {mk_payments}""",
    "gd_reviews": """
        SELECT review_id, order_id, CAST(review_score AS STRING) AS review_score, review_comment_title,
               CASE WHEN review_score = 1 THEN 'said "no",' || chr(10) || 'then left' ELSE review_comment_message END
                   AS review_comment_message,
               CAST(review_creation_date AS STRING) AS review_creation_date,
               CAST(review_answer_timestamp AS STRING) AS review_answer_timestamp
        FROM {mk_reviews}""",
    "gd_sellers": """
        SELECT seller_id, CAST(seller_zip_code_prefix AS STRING) AS seller_zip_code_prefix, seller_city,
               concat('S', substr(seller_state, 1, 1)) AS seller_state
        FROM {mk_sellers}""",
    # Payments whose integers are partly broken.
    "raw_integers": """
        SELECT order_id, payment_type, CAST(payment_value AS STRING) AS payment_value,
               CASE WHEN CAST(order_id AS BIGINT) % 17 = 0 THEN '2.5' WHEN CAST(order_id AS BIGINT) % 19 = 0 THEN '1.0'
                    ELSE CAST(payment_installments AS STRING) END AS payment_installments,
               CASE WHEN CAST(order_id AS BIGINT) % 23 = 0 THEN 'first'
                    ELSE CAST(payment_sequential AS STRING) END AS payment_sequential
        FROM {mk_payments}""",
    # Text of one type per column, for type inference.
    "raw_typed": """
        SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_totalprice > 100000 AS STRING) AS is_large,
               CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS STRING) AS total_text,
               CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS STRING) END AS maybe_custkey,
               CAST(NULL AS STRING) AS nothing, o_orderpriority AS order_priority, o_totalprice AS total_price,
               concat(CAST(o_orderdate AS STRING), CASE WHEN o_orderkey % 83 = 0 THEN '?' ELSE '' END) AS created_at
        FROM {orders}""",
}

_NAME = re.compile(r"\{([a-z_]+)\}")


class Testbed:
    """Test tables of one scale folder and the views derived from them."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._table(name) if name in TABLE_SCHEMAS else self._view(name)
        return self._frames[name]

    def _table(self, name: str) -> DataFrame:
        table = self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")
        size_shuffles(self.spark, table)
        return table

    def _view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        return self.spark.sql(text, **{part: self[part] for part in _NAME.findall(text)})

    @contextmanager
    def kept(self, name: str, *columns: str) -> Iterator[None]:
        """Within, columns of a view that several others of a run read are written once; its file goes afterwards, and what reads it."""
        before, path = dict(self._frames), scratch_folder(self.spark, "view")
        try:
            frame = self[name].select(*columns)
            write_parquet(frame, path)
            self._frames = {**before, name: self.spark.read.schema(frame.schema).parquet(path)}
            yield
        finally:
            self._frames = before
            discard(self.spark, path)

    def marketplace(self) -> dict[str, DataFrame]:
        """The tables the analyses read."""
        names = {
            "customers": "mk_customers",
            "orders": "mk_orders",
            "order_items": "mk_items",
            "order_payments": "mk_payments",
            "order_reviews": "mk_reviews",
            "products": "mk_model_products",
            "sellers": "mk_sellers",
        }
        return {table: self[view] for table, view in names.items()}

    def typed_sources(self) -> dict[str, DataFrame]:
        """Nine typed source tables with planted defects, for the contract checks."""
        names = {
            "customers": "pl_customers",
            "geolocation": "mk_geo",
            "orders": "pl_orders",
            "order_items": "pl_items",
            "order_payments": "pl_payments",
            "order_reviews": "pl_reviews",
            "products": "mk_products",
            "sellers": "mk_sellers",
            "product_category_name_translation": "mk_categories",
        }
        return {table: self[view] for table, view in names.items()}

    def raw_sources(self, **replaced: str) -> dict[str, DataFrame]:
        """Nine source tables as dirty text."""
        names = {
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
        return {table: self[view] for table, view in {**names, **replaced}.items()}


GOOD_SOURCES = {
    "customers": "gd_customers",
    "geolocation": "raw_geo",
    "orders": "gd_orders",
    "order_items": "gd_items",
    "order_payments": "gd_payments",
    "order_reviews": "gd_reviews",
    "products": "raw_products",
    "sellers": "gd_sellers",
    "product_category_name_translation": "raw_translation",
}


def with_views(sql: str, views: dict[str, str] | None = None) -> str:
    """Expand ``{view}`` names of a SQL text into common table expressions over the plain tables."""
    known = {**VIEWS, **(views or {})}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in known and name not in ordered:
                visit(known[name])
                if name not in ordered:
                    ordered.append(name)

    def plain(text: str) -> str:
        return _NAME.sub(lambda match: match.group(1), text)

    visit(sql)
    head = ",\n".join(f"{name} AS ({plain(known[name]).strip()})" for name in ordered)
    return f"WITH {head}\n{plain(sql).strip()}" if head else plain(sql).strip()


Query = Callable[[Testbed], DataFrame]
