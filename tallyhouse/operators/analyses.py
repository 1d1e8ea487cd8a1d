"""The ten named analyses."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.contracts import RESULT_COLUMNS
from tallyhouse.functions import measures as M
from tallyhouse.functions.rounding import rate_pct, round_money, round_ratio
from tallyhouse.functions.time import days_late, month_distance, month_start
from tallyhouse.operators import stages as S


def _facts(t: Mapping[str, DataFrame]) -> DataFrame:
    """Order facts, taken from the tables where a run has stored them."""
    if "order_facts" in t:
        return t["order_facts"]
    return S.order_facts(t["orders"], t["order_items"], t["order_reviews"])


def _customer_facts(t: Mapping[str, DataFrame]) -> DataFrame:
    """Order facts summed per customer id, taken from the tables where a run has stored them."""
    return t["customer_facts"] if "customer_facts" in t else customer_facts(_facts(t))


def _delivered(t: Mapping[str, DataFrame]) -> DataFrame:
    """Delivered orders with their mean review; a run's order facts hold them without another join."""
    if "order_facts" in t:
        return S.delivered_facts(t["order_facts"])
    return S.delivered_orders_reviewed(t["orders"], S.review_by_order(t["order_reviews"]))


# The sums of orders that the executive summary reads; the states read some of them.
CUSTOMER_SUMS = (
    "first_purchase",
    "last_purchase",
    "total_orders",
    "delivered_orders",
    "canceled_orders",
    "delivered_gmv",
    "on_time_deliveries",
    "dated_deliveries",
    "delivery_time",
    "timed_deliveries",
    "review_total",
    "reviewed_orders",
    "low_reviews",
)


def customer_facts(facts: DataFrame) -> DataFrame:
    """One row per customer id; the GMV is null where no delivered order has items."""
    return facts.groupBy("customer_id").agg(*M.order_partials(*CUSTOMER_SUMS))


def executive_summary(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row for the whole data set.

    Orders are reduced to customer ids, then to persons, then to the single row: distinct customers and repeat
    customers fall out of the same pass, without a second scan or a multi-distinct expansion.
    """
    names = CUSTOMER_SUMS
    # Delivered orders without items count as 0 here.
    gmv = F.when(F.col("delivered_orders") > 0, F.coalesce("delivered_gmv", F.lit(0).cast("decimal(34,2)")))
    per_id = _customer_facts(t).withColumn("delivered_gmv", gmv)
    persons = (
        per_id.join(t["customers"].select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(*M.merge_partials(*names))
    )
    total = persons.agg(
        *M.merge_partials(*names),
        F.count("customer_unique_id").alias("unique_customers"),
        F.count_if(F.col("delivered_orders") >= 1).alias("delivered_customers"),
        F.count_if(F.col("delivered_orders") >= 2).alias("repeat_customers"),
    )
    if "delivered_lines" in t:
        sellers = t["delivered_lines"]
    else:
        delivered = t["orders"].filter(M.delivered()).select("order_id")
        sellers = t["order_items"].select("order_id", "seller_id").distinct().join(delivered, "order_id", "left_semi")
    active_sellers = sellers.select(F.count_distinct("seller_id")).scalar()
    return total.filter(F.col("total_orders") > 0).select(
        F.col("first_purchase").cast("date").alias("first_order_date"),
        F.col("last_purchase").cast("date").alias("last_order_date"),
        "total_orders",
        "delivered_orders",
        "unique_customers",
        active_sellers.alias("active_sellers"),
        M.delivered_gmv(),
        M.delivered_average_order_value(),
        M.cancellation_rate_pct(),
        M.on_time_delivery_rate_pct(),
        M.average_delivery_days(),
        M.average_review_score(),
        M.low_review_rate_pct(),
        rate_pct(F.col("repeat_customers"), F.col("delivered_customers")).alias("repeat_customer_rate_pct"),
    )


def monthly_performance(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per purchase month, every order status."""
    facts = _facts(t).select(
        "*", month_start("order_purchase_timestamp").alias("order_month")
    )
    facts = facts.withColumn("item_revenue", F.coalesce("item_revenue", F.lit(0).cast("decimal(24,2)")))
    months = facts.groupBy("order_month").agg(
        *M.order_partials(
            "total_orders",
            "delivered_orders",
            "canceled_orders",
            "delivered_gmv",
            "on_time_deliveries",
            "dated_deliveries",
            "delivery_time",
            "timed_deliveries",
            "review_total",
            "reviewed_orders",
        )
    )
    return months.select(
        "order_month",
        "total_orders",
        "delivered_orders",
        "canceled_orders",
        M.delivered_gmv(),
        M.delivered_average_order_value(),
        M.cancellation_rate_pct(),
        M.on_time_delivery_rate_pct(),
        M.average_delivery_days(),
        M.average_review_score(),
    ).orderBy(F.asc_nulls_last("order_month"))


def category_performance(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per category over delivered orders; an order counts once in each category it holds."""
    if "delivered_lines" in t:
        grain = S.category_lines(t["delivered_lines"], t["products"])
    else:
        grain = S.category_order(t["order_items"], t["orders"], t["products"], S.review_by_order(t["order_reviews"]))
    totals = grain.groupBy("category_name").agg(
        F.count("*").alias("delivered_orders"),
        F.sum("item_count").alias("items_sold"),
        F.sum("item_revenue").alias("revenue"),
        F.sum("freight_revenue").alias("freight"),
        M.review_total().alias("review_total"),
        F.count("average_review_score").alias("reviewed_orders"),
    )
    return totals.select(
        "category_name",
        "delivered_orders",
        "items_sold",
        round_money(F.col("revenue")).alias("delivered_gmv"),
        round_money(F.col("freight")).alias("freight_revenue"),
        round_ratio(F.col("revenue"), F.col("items_sold"), places=2).alias("average_item_price"),
        M.average_review_score(),
    ).orderBy(F.desc_nulls_first("delivered_gmv"), F.asc_nulls_last("category_name"))


def state_performance(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per customer state; the GMV stays null where no delivered order has items."""
    names = [
        "total_orders",
        "delivered_orders",
        "canceled_orders",
        "delivered_gmv",
        "on_time_deliveries",
        "dated_deliveries",
        "review_total",
        "reviewed_orders",
    ]
    states = (
        _customer_facts(t).join(t["customers"].select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(*M.merge_partials(*names))
    )
    return states.select(
        "customer_state",
        "total_orders",
        "delivered_orders",
        M.delivered_gmv(),
        M.cancellation_rate_pct(),
        M.on_time_delivery_rate_pct(),
        M.average_review_score(),
    ).orderBy(F.desc_nulls_first("delivered_gmv"), F.asc_nulls_last("customer_state"))


def payment_method_performance(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per payment type over all payments."""
    payments = t["order_payments"]
    types = payments.groupBy("payment_type").agg(
        F.count("*").alias("payment_records"),
        F.count_distinct("order_id").alias("orders_using_method"),
        F.sum("payment_value").alias("value"),
        F.count("payment_value").alias("valued"),
        F.sum("payment_installments").alias("installments"),
        F.count("payment_installments").alias("in_installments"),
    )
    grand_total = payments.select(F.sum("payment_value")).scalar()
    return types.select(
        "payment_type",
        "payment_records",
        "orders_using_method",
        round_money(F.col("value")).alias("payment_value"),
        round_ratio(F.col("value"), F.col("valued"), places=2).alias("average_payment_record_value"),
        round_ratio(F.col("installments"), F.col("in_installments")).alias("average_installments"),
        rate_pct(F.col("value"), grand_total).alias("payment_value_share_pct"),
    ).orderBy(F.desc_nulls_first("payment_value"), F.asc_nulls_last("payment_type"))


def order_status_distribution(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per order status."""
    counts = t["orders"].groupBy("order_status").agg(F.count("*").alias("order_count"))
    grand_total = counts.select(F.sum("order_count")).scalar()
    return counts.select(
        "order_status", "order_count", rate_pct(F.col("order_count"), grand_total).alias("order_share_pct")
    ).orderBy(F.desc("order_count"), F.asc_nulls_last("order_status"))


# Timing bands as (last delay day of the band, label); the final band is open.
TIMING_BANDS = (
    (-2, "2+ days early"),
    (0, "on time / 1 day early"),
    (3, "1–3 days late"),
    (7, "4–7 days late"),
    (None, "8+ days late"),
)


def delivery_review_relationship(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per timing band of the delivered orders that have both dates."""
    dated = _delivered(t).filter(
        F.col("order_delivered_customer_date").isNotNull() & F.col("order_estimated_delivery_date").isNotNull()
    )
    delay = F.col("delay_days")
    label, number = F.lit(TIMING_BANDS[-1][1]), F.lit(len(TIMING_BANDS))
    for position, (last_day, text) in reversed(list(enumerate(TIMING_BANDS[:-1], start=1))):
        label = F.when(delay <= last_day, text).otherwise(label)
        number = F.when(delay <= last_day, position).otherwise(number)
    bands = (
        dated.select(
            days_late("order_delivered_customer_date", "order_estimated_delivery_date").alias("delay_days"),
            "average_review_score",
        )
        .groupBy(label.alias("delivery_timing_band"), number.alias("band_order"))
        .agg(
            F.count("*").alias("delivered_orders"),
            F.sum("delay_days").alias("delay"),
            M.review_total().alias("review_total"),
            F.count("average_review_score").alias("reviewed_orders"),
            F.count_if(M.low_review()).alias("low_reviews"),
        )
    )
    return bands.select(
        "delivery_timing_band",
        "band_order",
        "delivered_orders",
        round_ratio(F.col("delay"), F.col("delivered_orders")).alias("average_delay_days"),
        M.average_review_score(),
        M.low_review_rate_pct(),
    ).orderBy("band_order")


def customer_purchase_frequency(t: Mapping[str, DataFrame]) -> DataFrame:
    """Persons by number of delivered orders: 1, 2, 3, 4 and more."""
    persons = S.delivered_customer_orders(t["orders"], t["customers"])
    bands = (
        persons.groupBy(F.least("delivered_orders", F.lit(4)).cast("int").alias("band_order"))
        .agg(F.count("*").alias("customers"), F.sum("delivered_orders").alias("orders"))
        .withColumn("frequency_band", F.expr("elt(band_order, '1 order', '2 orders', '3 orders', '4+ orders')"))
    )
    everyone = bands.select(F.sum("customers")).scalar()
    return bands.select(
        "frequency_band",
        "band_order",
        "customers",
        rate_pct(F.col("customers"), everyone).alias("customer_share_pct"),
        round_ratio(F.col("orders"), F.col("customers")).alias("average_delivered_orders"),
    ).orderBy("band_order")


def monthly_customer_cohorts(t: Mapping[str, DataFrame]) -> DataFrame:
    """Activity by first delivered month and months since; a row exists only where somebody was active.

    The cohort size is read from the month-0 row of the same cohort, a window over at most one row per month.
    """
    activity = (
        S.cohorted_activity(t["orders"], t["customers"])
        .groupBy("cohort_month", month_distance("order_month", "cohort_month").alias("month_number"))
        .agg(F.count("customer_unique_id").alias("active_customers"))
    )
    size = F.max(F.when(F.col("month_number") == 0, F.col("active_customers"))).over(W.partitionBy("cohort_month"))
    return (
        activity.withColumn("cohort_size", size)
        .select(
            "cohort_month",
            "month_number",
            "cohort_size",
            "active_customers",
            rate_pct(F.col("active_customers"), F.col("cohort_size")).alias("retention_rate_pct"),
        )
        .orderBy("cohort_month", "month_number")
    )


def seller_scorecard(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per seller with a delivered order; undated deliveries count as late here."""
    if "delivered_lines" in t:
        grain = S.seller_lines(t["delivered_lines"])
    else:
        grain = S.seller_order(t["order_items"], t["orders"], S.review_by_order(t["order_reviews"]))
    totals = grain.groupBy("seller_id").agg(
        F.count("order_id").alias("delivered_orders"),
        F.sum("item_revenue").alias("revenue"),
        F.count_if("delivered_on_time").alias("on_time"),
        M.review_total().alias("review_total"),
        F.count("average_review_score").alias("reviewed_orders"),
        F.count_if(M.low_review()).alias("low_reviews"),
    )
    return (
        totals.join(t["sellers"].select("seller_id", "seller_state"), "seller_id")
        .select(
            "seller_id",
            "seller_state",
            "delivered_orders",
            round_money(F.col("revenue")).alias("delivered_gmv"),
            round_ratio(F.col("revenue"), F.col("delivered_orders"), places=2).alias("average_order_revenue"),
            rate_pct(F.col("on_time"), F.col("delivered_orders")).alias("on_time_delivery_rate_pct"),
            M.average_review_score(),
            M.low_review_rate_pct(),
        )
        .orderBy(F.desc_nulls_first("delivered_gmv"), "seller_id")
    )


ANALYSES: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "executive_summary": executive_summary,
    "monthly_performance": monthly_performance,
    "category_performance": category_performance,
    "state_performance": state_performance,
    "payment_method_performance": payment_method_performance,
    "order_status_distribution": order_status_distribution,
    "delivery_review_relationship": delivery_review_relationship,
    "customer_purchase_frequency": customer_purchase_frequency,
    "monthly_customer_cohorts": monthly_customer_cohorts,
    "seller_scorecard": seller_scorecard,
}


class ResultContractError(ValueError):
    """A result differs from its documented columns or has no row."""


def check_result(name: str, columns: list[str], is_empty: bool = False) -> None:
    """Raise unless the result has exactly the documented columns, in order, and a row."""
    expected = RESULT_COLUMNS.get(name)
    if expected is None:
        raise ResultContractError(f"Unknown analysis {name!r}.")
    if tuple(columns) != expected:
        raise ResultContractError(f"Columns of {name} are {tuple(columns)}, not {expected}.")
    if is_empty:
        raise ResultContractError(f"{name} has no rows.")


def validate_analytics_result(name: str, result: DataFrame) -> None:
    check_result(name, result.columns)
    check_result(name, result.columns, result.isEmpty())
