"""Reusable stages of the analyses: items and reviews are reduced to order grain before any join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.functions.measures import delivered as is_delivered
from tallyhouse.functions.measures import on_time
from tallyhouse.functions.time import month_start
from tallyhouse.operators.skew import join_dimension

ORDER_DATES = ["order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"]


def review_by_order(reviews: DataFrame) -> DataFrame:
    """Mean review score per order."""
    return reviews.groupBy("order_id").agg(F.avg("review_score").alias("average_review_score"))


def order_value(items: DataFrame) -> DataFrame:
    """Item revenue and freight per order."""
    return items.groupBy("order_id").agg(
        F.sum("price").alias("item_revenue"), F.sum("freight_value").alias("freight_revenue")
    )


def order_facts(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per order with its revenue (null without items) and mean review.

    All three inputs meet on ``order_id``: the two reduced sides leave their aggregation already partitioned
    by it, so only the orders are shuffled for the joins.
    """
    value = order_value(items).select("order_id", "item_revenue")
    return (
        orders.select("order_id", "customer_id", "order_status", *ORDER_DATES)
        .join(value, "order_id", "left")
        .join(review_by_order(reviews), "order_id", "left")
    )


def order_metrics(orders: DataFrame, customers: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders of known customers with revenue (0 without items) and mean review."""
    facts = order_facts(orders, items, reviews)
    people = customers.select("customer_id", "customer_unique_id")
    return facts.join(people, "customer_id").select(
        "order_id",
        "customer_unique_id",
        "order_status",
        *ORDER_DATES,
        F.coalesce("item_revenue", F.lit(0).cast("decimal(24,2)")).alias("item_revenue"),
        "average_review_score",
    )


def delivered_customer_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivered orders per person.

    Orders are counted per customer id before the join, so a customer with very many orders is one row in it.
    ``order_id`` is the key of orders, hence a count of rows is the count of distinct orders.
    """
    per_id = orders.filter(is_delivered()).groupBy("customer_id").agg(F.count("order_id").alias("delivered_orders"))
    return (
        per_id.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.sum("delivered_orders").alias("delivered_orders"))
    )


def delivered_orders_reviewed(orders: DataFrame, order_reviews: DataFrame) -> DataFrame:
    """Delivered orders with their mean review, given per order."""
    return (
        orders.filter(is_delivered())
        .select("order_id", "order_delivered_customer_date", "order_estimated_delivery_date")
        .join(order_reviews, "order_id", "left")
    )


def delivered_facts(facts: DataFrame) -> DataFrame:
    """The delivered orders of the order facts, as ``delivered_orders_reviewed`` gives them."""
    return facts.filter(is_delivered()).select(
        "order_id", "order_delivered_customer_date", "order_estimated_delivery_date", "average_review_score"
    )


def delivered_lines(items: DataFrame, facts: DataFrame) -> DataFrame:
    """Per (delivered order, product, seller): item count, revenue, freight, and the order's mean review and timing.

    Lines meet the order once, and their sums and ``first_of_seller``, true on one row of each (order, seller), need no
    other shuffle. Both the categories and the sellers of orders are sums of these rows.
    """
    delivered = delivered_facts(facts).select(
        "order_id", "average_review_score", F.coalesce(on_time(), F.lit(False)).alias("delivered_on_time")
    )
    lines = (
        items.select("order_id", "product_id", "seller_id", "price", "freight_value")
        .join(delivered, "order_id")
        .groupBy("order_id", "product_id", "seller_id")
        .agg(
            F.count("*").alias("item_count"),
            F.sum("price").alias("item_revenue"),
            F.sum("freight_value").alias("freight_revenue"),
            F.max("average_review_score").alias("average_review_score"),
            F.max("delivered_on_time").alias("delivered_on_time"),
        )
    )
    of_seller = W.partitionBy("order_id", "seller_id").orderBy("product_id")
    return lines.withColumn("first_of_seller", F.row_number().over(of_seller) == 1)


def category_order(items: DataFrame, orders: DataFrame, products: DataFrame, order_reviews: DataFrame) -> DataFrame:
    """Per (category, delivered order): item count, revenue, freight and the order's mean review.

    Items shrink to (order, product) first; the review joins on the partitioning the order join needs anyway. Products on
    a large share of the lines get their category by broadcast.
    """
    lines = items.groupBy("order_id", "product_id").agg(
        F.count("*").alias("item_count"),
        F.sum("price").alias("item_revenue"),
        F.sum("freight_value").alias("freight_revenue"),
    )
    delivered = delivered_orders_reviewed(orders, order_reviews).select("order_id", "average_review_score")
    return category_lines(lines.join(delivered, "order_id"), products)


def category_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """The rows of ``category_order`` from lines of delivered orders."""
    lines = lines.select("order_id", "product_id", "item_count", "item_revenue", "freight_revenue", "average_review_score")
    categories = products.select("product_id", F.col("product_category_name_english").alias("category_name"))
    return (
        join_dimension(lines, categories, "product_id", "category_name", "order_id")
        .groupBy("category_name", "order_id")
        .agg(
            F.sum("item_count").alias("item_count"),
            F.sum("item_revenue").alias("item_revenue"),
            F.sum("freight_revenue").alias("freight_revenue"),
            F.max("average_review_score").alias("average_review_score"),
        )
    )


def seller_order(items: DataFrame, orders: DataFrame, order_reviews: DataFrame) -> DataFrame:
    """Per (seller, delivered order): revenue, freight, on time or not, and the order's mean review.

    Both dates belong to the order, so the reduced item rows are at the final grain already.
    """
    lines = items.groupBy("order_id", "seller_id").agg(
        F.sum("price").alias("item_revenue"), F.sum("freight_value").alias("freight_revenue")
    )
    delivered = delivered_orders_reviewed(orders, order_reviews).select(
        "order_id", "average_review_score", F.coalesce(on_time(), F.lit(False)).alias("delivered_on_time")
    )
    return lines.join(delivered, "order_id").select(
        "seller_id", "order_id", "item_revenue", "freight_revenue", "delivered_on_time", "average_review_score"
    )


def seller_lines(lines: DataFrame) -> DataFrame:
    """Lines of delivered orders by seller; the order and what belongs to it stand on the first line of a seller only."""
    once = lambda column: F.when(F.col("first_of_seller"), F.col(column)).alias(column)
    return lines.select(
        "seller_id", "item_revenue", "freight_revenue", *map(once, ("order_id", "delivered_on_time", "average_review_score"))
    )


def cohorted_activity(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct (person, month with a delivered order) and the person's first month.

    The window group of a person holds at most one row per calendar month.
    """
    per_id = (
        orders.filter(is_delivered())
        .select("customer_id", month_start("order_purchase_timestamp").alias("order_month"))
        .distinct()
    )
    activity = (
        per_id.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .select("customer_unique_id", "order_month")
        .distinct()
    )
    first = F.min("order_month").over(W.partitionBy("customer_unique_id"))
    return activity.withColumn("cohort_month", first)
