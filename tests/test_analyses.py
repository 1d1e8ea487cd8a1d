from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse.functions.rounding import rate_pct, round_ratio
from tallyhouse.operators import analyses as A
from tallyhouse.operators import insights as E
from tallyhouse.operators import stages as S
from tallyhouse.sources.testbed import Testbed

FOLDER = "/root/testdata/sf0.001"


def at(text):
    return dt.datetime.fromisoformat(text) if text else None


@pytest.fixture(scope="module")
def tiny(spark):
    """Six orders with every awkward case: no items, no dates, late by time of day only, no review."""
    orders = [
        ("o1", "c1", "delivered", "2017-01-05 10:00:00", "2017-01-10 23:00:00", "2017-01-10"),
        ("o2", "c2", "delivered", "2017-01-20 10:00:00", "2017-02-10 10:00:00", "2017-02-01"),
        ("o3", "c3", "delivered", "2017-02-02 00:00:00", None, "2017-02-20"),
        ("o4", "c3", "delivered", "2017-03-02 00:00:00", "2017-03-04 00:00:00", "2017-03-10"),
        ("o5", "c4", "canceled", "2017-03-05 00:00:00", None, "2017-03-20"),
        ("o6", "c5", "shipped", "2017-04-05 00:00:00", None, "2017-04-20"),
    ]
    return {
        "orders": spark.createDataFrame(
            [(o, c, s, at(p), at(d), at(e)) for o, c, s, p, d, e in orders],
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
            "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
        ),
        "customers": spark.createDataFrame(
            [("c1", "u1", "SP"), ("c2", "u1", "SP"), ("c3", "u2", "RJ"), ("c4", "u3", "MG"), ("c5", "u4", "MG")],
            "customer_id string, customer_unique_id string, customer_state string",
        ),
        "order_items": spark.createDataFrame(
            [("o1", "p1", "s1", "10.00", "1.00"), ("o1", "p1", "s1", "20.00", "1.00"), ("o1", "p2", "s2", "5.00", "1"),
             ("o2", "p1", "s1", "7.00", "0"), ("o4", "p2", "s1", "8.01", "0"), ("o5", "p2", "s2", "99.00", "0")],
            "order_id string, product_id string, seller_id string, price string, freight_value string",
        ).withColumns({c: F.col(c).cast("decimal(14,2)") for c in ("price", "freight_value")}),
        "order_payments": spark.createDataFrame(
            [("o1", "boleto", 1, 35.0), ("o1", "boleto", 2, 1.0), ("o2", "card", 3, 7.0)],
            "order_id string, payment_type string, payment_installments int, payment_value double",
        ).withColumn("payment_value", F.col("payment_value").cast("decimal(14,2)")),
        "order_reviews": spark.createDataFrame(
            [("o1", 5), ("o1", 4), ("o2", 1), ("o5", 2)], "order_id string, review_score int"
        ),
        "products": spark.createDataFrame(
            [("p1", "toys"), ("p2", "books")], "product_id string, product_category_name_english string"
        ),
        "sellers": spark.createDataFrame([("s1", "SP"), ("s2", "RJ")], "seller_id string, seller_state string"),
    }


def test_executive_summary(tiny):
    row = A.executive_summary(tiny).first().asDict()
    assert row == {
        "first_order_date": dt.date(2017, 1, 5),
        "last_order_date": dt.date(2017, 4, 5),
        "total_orders": 6,
        "delivered_orders": 4,
        "unique_customers": 4,
        "active_sellers": 2,
        "delivered_gmv": row["delivered_gmv"],
        "delivered_average_order_value": 12.50,
        "cancellation_rate_pct": 16.67,
        "on_time_delivery_rate_pct": 66.67,
        "average_delivery_days": 9.51,
        "average_review_score": 2.5,
        "low_review_rate_pct": 66.67,
        "repeat_customer_rate_pct": 100.0,
    }
    assert float(row["delivered_gmv"]) == 50.01


def test_state_gmv_stays_null_and_sorts_first(tiny):
    found = A.state_performance(tiny).collect()
    assert [(r.customer_state, r.delivered_gmv is None) for r in found] == [("MG", True), ("SP", False), ("RJ", False)]


def test_month_without_delivery_has_null_gmv(tiny):
    months = {r.order_month: r for r in A.monthly_performance(tiny).collect()}
    assert months[dt.date(2017, 4, 1)].delivered_gmv is None
    assert float(months[dt.date(2017, 2, 1)].delivered_gmv) == 0.0
    assert months[dt.date(2017, 2, 1)].on_time_delivery_rate_pct is None
    assert months[dt.date(2017, 3, 1)].canceled_orders == 1


def test_seller_counts_undated_orders_as_late(tiny):
    tables = dict(tiny)
    extra = tiny["order_items"].filter("order_id = 'o4'").withColumn("order_id", F.lit("o3"))
    tables["order_items"] = tiny["order_items"].unionByName(extra)
    found = {r.seller_id: r for r in A.seller_scorecard(tables).collect()}
    assert (found["s1"].delivered_orders, found["s1"].on_time_delivery_rate_pct) == (4, 50.0)
    assert found["s1"].average_review_score == 2.75 and found["s2"].on_time_delivery_rate_pct == 100.0


def test_category_counts_an_order_once_and_ignores_item_weights(tiny):
    found = {r.category_name: r for r in A.category_performance(tiny).collect()}
    assert (found["toys"].delivered_orders, found["toys"].items_sold) == (2, 3)
    assert found["toys"].average_item_price == 12.33 and found["toys"].average_review_score == 2.75


def test_payments_bands_and_cohorts(tiny):
    payments = {r.payment_type: r for r in A.payment_method_performance(tiny).collect()}
    assert (payments["boleto"].payment_records, payments["boleto"].orders_using_method) == (2, 1)
    assert payments["boleto"].payment_value_share_pct == 83.72
    bands = [(r.delivery_timing_band, r.delivered_orders) for r in A.delivery_review_relationship(tiny).collect()]
    assert bands == [("2+ days early", 1), ("on time / 1 day early", 1), ("8+ days late", 1)]
    frequency = [(r.frequency_band, r.customers) for r in A.customer_purchase_frequency(tiny).collect()]
    assert frequency == [("2 orders", 2)]
    cohorts = [tuple(r)[:4] for r in A.monthly_customer_cohorts(tiny).collect()]
    assert cohorts == [
        (dt.date(2017, 1, 1), 0, 1, 1),
        (dt.date(2017, 2, 1), 0, 1, 1),
        (dt.date(2017, 2, 1), 1, 1, 1),
    ]
    assert E.weighted_month_one_activity(A.monthly_customer_cohorts(tiny)).first().active_customers == 1
    matrix = E.cohort_matrix(A.monthly_customer_cohorts(tiny)).collect()
    assert [tuple(r) for r in matrix] == [("2017-01", 100.0, None), ("2017-02", 100.0, 100.0)]


def test_band_limits(spark):
    days = [-3, -2, -1, 0, 1, 3, 4, 7, 8]
    base = at("2017-06-15 00:00:00")
    orders = spark.createDataFrame(
        [(str(d), "delivered", base + dt.timedelta(days=d), base) for d in days],
        "order_id string, order_status string, order_delivered_customer_date timestamp_ntz, "
        "order_estimated_delivery_date timestamp_ntz",
    )
    reviews = spark.createDataFrame([("0", 1)], "order_id string, review_score int")
    bands = A.delivery_review_relationship({"orders": orders, "order_reviews": reviews}).collect()
    assert [(r.band_order, r.delivered_orders, r.average_delay_days) for r in bands] == [
        (1, 2, -2.5), (2, 2, -0.5), (3, 2, 2.0), (4, 2, 5.5), (5, 1, 8.0),
    ]


def test_result_contract(spark):
    with pytest.raises(A.ResultContractError, match="Columns of order_status_distribution"):
        A.validate_analytics_result("order_status_distribution", spark.range(1))
    good = spark.createDataFrame([("delivered", 1, 100.0)], "order_status string, order_count long, order_share_pct double")
    A.validate_analytics_result("order_status_distribution", good)
    with pytest.raises(A.ResultContractError, match="no rows"):
        A.validate_analytics_result("order_status_distribution", good.limit(0))
    with pytest.raises(A.ResultContractError, match="Unknown analysis"):
        A.validate_analytics_result("unknown", good)


def test_totals_agree_across_analyses(spark):
    tables = Testbed(spark, FOLDER).marketplace()
    summary = A.executive_summary(tables).first()
    states = A.state_performance(tables).agg(F.sum("total_orders"), F.sum("delivered_gmv")).first()
    assert states[0] == summary.total_orders and states[1] == summary.delivered_gmv
    assert A.category_performance(tables).agg(F.sum("delivered_gmv")).first()[0] == summary.delivered_gmv
    assert abs(A.order_status_distribution(tables).agg(F.sum("order_share_pct")).first()[0] - 100) < 0.05
    first_months = A.monthly_customer_cohorts(tables).filter("month_number = 0")
    assert set(rows(first_months, "retention_rate_pct")) == {100.0}


def test_hot_customer_reaches_the_customer_join_as_one_row(spark):
    """Orders are counted per customer id below the join, so its input is the number of customer ids."""
    orders = spark.range(10_000).selectExpr(
        "CAST(id AS string) AS order_id", "if(id % 3 = 0, 'hot', CAST(id AS string)) AS customer_id",
        "'delivered' AS order_status",
    )
    customers = orders.select("customer_id").distinct().selectExpr("customer_id", "customer_id AS customer_unique_id")
    found = S.delivered_customer_orders(orders, customers)
    assert found.agg(F.max("delivered_orders")).first()[0] == 3334
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join")
    assert "Aggregate [customer_id" in plan[join:]


def test_rates_are_rounded_once(spark):
    pairs = [(100249999999, 5000000000000), (1, 800), (-1, 800), (201, 20000), (0, 5), (3, 0), (None, 5)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    found = [row[0] for row in df.select(rate_pct(F.col("a"), F.col("b"))).collect()]
    assert found == [2.0, 0.13, -0.13, 1.01, 0.0, None, None]
    halves = spark.createDataFrame([("0.01", 2), ("0.03", 2), ("2.50", 1000)], "a string, b bigint")
    money = F.col("a").cast("decimal(14,2)")
    assert [row[0] for row in halves.select(round_ratio(money, F.col("b"), places=2)).collect()] == [0.01, 0.02, 0.0]


def test_delivery_times_beyond_a_bigint_of_microseconds(spark):
    orders = spark.range(60).selectExpr(
        "concat('o', id) AS order_id", "concat('c', id % 7) AS customer_id", "'delivered' AS order_status",
        "TIMESTAMP_NTZ'0001-01-01' AS order_purchase_timestamp", "TIMESTAMP_NTZ'9999-12-31' AS order_delivered_customer_date",
        "CAST(NULL AS timestamp_ntz) AS order_estimated_delivery_date",
    )
    tables = {
        "orders": orders,
        "customers": spark.range(7).selectExpr("concat('c', id) AS customer_id", "concat('u', id % 3) AS customer_unique_id"),
        "order_items": spark.createDataFrame([], "order_id string, seller_id string, price decimal(14,2), freight_value decimal(14,2)"),
        "order_reviews": spark.createDataFrame([], "order_id string, review_score int"),
    }
    days = (dt.date(9999, 12, 31) - dt.date(1, 1, 1)).days
    assert days * 86_400_000_000 * 60 > 2**63
    assert rows(A.executive_summary(tables), "average_delivery_days") == [days]
    assert rows(A.monthly_performance(tables), "average_delivery_days") == [days]
