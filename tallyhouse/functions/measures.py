"""The business measures as aggregates.

Orders are summed in two steps: ``order_partials`` reduces them to a fine key (a customer, a month), and
``merge_partials`` adds those partial rows up for a coarser key. A key that holds a third of all orders is
thereby reduced before any join or shuffle on it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.rounding import rate_pct, round_money, round_ratio
from tallyhouse.functions.time import elapsed_microseconds


def delivered() -> Column:
    return F.col("order_status") == "delivered"


def canceled() -> Column:
    return F.col("order_status") == "canceled"


def low_review() -> Column:
    return F.col("average_review_score") <= 2


def dated_delivery() -> Column:
    return (
        delivered()
        & F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull()
    )


def on_time() -> Column:
    return F.col("order_delivered_customer_date").cast("date") <= F.col("order_estimated_delivery_date").cast("date")


# Decimals of an order's mean score in sums, which are exact and so do not depend on the partitions.
REVIEW_PLACES = 12
MICROSECONDS_PER_DAY = 86_400_000_000


def review_total() -> Column:
    return F.sum(F.col("average_review_score").cast(f"decimal(24,{REVIEW_PLACES})"))


_PARTIALS = {
    "total_orders": lambda: F.count("*"),
    "delivered_orders": lambda: F.count_if(delivered()),
    "canceled_orders": lambda: F.count_if(canceled()),
    "dated_deliveries": lambda: F.count_if(dated_delivery()),
    "on_time_deliveries": lambda: F.count_if(dated_delivery() & on_time()),
    "delivered_gmv": lambda: F.sum(F.when(delivered(), F.col("item_revenue"))),
    # As decimals: some seven million deliveries of two weeks are more microseconds than a bigint holds.
    "delivery_time": lambda: F.sum(
        F.when(
            delivered(),
            elapsed_microseconds("order_purchase_timestamp", "order_delivered_customer_date").cast("decimal(19,0)"),
        )
    ),
    "timed_deliveries": lambda: F.count_if(delivered() & F.col("order_delivered_customer_date").isNotNull()),
    "review_total": lambda: review_total(),
    "reviewed_orders": lambda: F.count("average_review_score"),
    "low_reviews": lambda: F.count_if(low_review()),
    "first_purchase": lambda: F.min("order_purchase_timestamp"),
    "last_purchase": lambda: F.max("order_purchase_timestamp"),
}


def order_partials(*names: str) -> list[Column]:
    """Partial aggregates over order rows."""
    return [_PARTIALS[name]().alias(name) for name in names]


def merge_partials(*names: str) -> list[Column]:
    """Aggregates that add partial rows up."""
    combine = {"first_purchase": F.min, "last_purchase": F.max}
    return [combine.get(name, F.sum)(name).alias(name) for name in names]


# Final measures over merged partials.


def delivered_gmv() -> Column:
    return round_money(F.col("delivered_gmv")).alias("delivered_gmv")


def delivered_average_order_value() -> Column:
    return round_ratio(F.col("delivered_gmv"), F.col("delivered_orders"), places=2).alias("delivered_average_order_value")


def cancellation_rate_pct() -> Column:
    return rate_pct(F.col("canceled_orders"), F.col("total_orders")).alias("cancellation_rate_pct")


def on_time_delivery_rate_pct() -> Column:
    return rate_pct(F.col("on_time_deliveries"), F.col("dated_deliveries")).alias("on_time_delivery_rate_pct")


def average_delivery_days() -> Column:
    possible = F.col("timed_deliveries").cast("decimal(19,0)") * F.lit(MICROSECONDS_PER_DAY)
    return round_ratio(F.col("delivery_time"), possible).alias("average_delivery_days")


def average_review_score() -> Column:
    return round_ratio(F.col("review_total"), F.col("reviewed_orders"), places=REVIEW_PLACES).alias("average_review_score")


def low_review_rate_pct() -> Column:
    return rate_pct(F.col("low_reviews"), F.col("reviewed_orders")).alias("low_review_rate_pct")
