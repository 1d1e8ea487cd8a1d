"""Expected results of stages and analyses.

Everything about an order is gathered in one ledger, a grouping of all rows that name it. Rates and means are whole
quotients with their remainders, on money in cents, time in microseconds and scores in units of 10^-12.
"""

from __future__ import annotations


def hundredths(top: str, bottom: str) -> str:
    """top / bottom of whole numbers with two decimals, half away from zero."""
    top, bottom = f"CAST({top} AS HUGEINT)", f"CAST({bottom} AS HUGEINT)"
    quotient, rest = f"(100 * abs({top})) // {bottom}", f"(100 * abs({top})) % {bottom}"
    up = f"CASE WHEN 2 * ({rest}) >= {bottom} THEN 1 ELSE 0 END"
    return f"CASE WHEN {bottom} <> 0 THEN sign({top}) * CAST({quotient} + {up} AS DOUBLE) / 100 END"


def cents(value: str) -> str:
    return f"CAST(ROUND(100 * CAST({value} AS DOUBLE)) AS HUGEINT)"


def rate(top: str, bottom: str) -> str:
    """Percentage of two counts or two amounts."""
    return hundredths(f"100 * {cents(top)}", cents(bottom))


def money(value: str) -> str:
    return f"CAST(ROUND({value}, 2) AS DOUBLE)"


def each(amount: str, number: str) -> str:
    """Amount per piece."""
    return hundredths(cents(amount), f"100 * ({number})")


SCORE = hundredths("SUM(CAST(ROUND(score * 1e12) AS HUGEINT))", "1000000000000 * COUNT(score)")
LOW = rate("SUM(CASE WHEN score <= 2 THEN 1 ELSE 0 END)", "COUNT(score)")
DONE = "order_status = 'delivered'"
PUNCTUAL = "CAST(got AS DATE) <= CAST(due AS DATE)"
DATED = f"{DONE} AND got IS NOT NULL AND due IS NOT NULL"
MONTH = "CAST(date_trunc('month', bought) AS DATE)"


def number(condition: str) -> str:
    return f"SUM(CASE WHEN {condition} THEN 1 ELSE 0 END)"


CANCELED = rate(number("order_status = 'canceled'"), "COUNT(*)")
ON_TIME = rate(number(f"{DATED} AND {PUNCTUAL}"), number(DATED))
GMV = f"SUM(CASE WHEN {DONE} THEN revenue END)"
ORDER_VALUE = each(GMV, number(DONE))
DAYS = hundredths(
    f"SUM(CASE WHEN {DONE} THEN date_diff('microsecond', bought, got) END)",
    f"86400000000 * {number(f'{DONE} AND got IS NOT NULL')}",
)

STAGE_VIEWS = {
    "ledger": """
        SELECT order_id, any_value(customer_id) AS customer_id, any_value(order_status) AS order_status,
               any_value(bought) AS bought, any_value(got) AS got, any_value(due) AS due,
               SUM(price) AS sold, SUM(freight) AS freight, AVG(stars) AS score
        FROM (SELECT order_id, customer_id, order_status, order_purchase_timestamp AS bought,
                     order_delivered_customer_date AS got, order_estimated_delivery_date AS due,
                     NULL AS price, NULL AS freight, NULL AS stars, 1 AS own FROM {mk_orders}
              UNION ALL BY NAME SELECT order_id, price, freight_value AS freight, 0 AS own FROM {mk_items}
              UNION ALL BY NAME SELECT order_id, review_score AS stars, 0 AS own FROM {mk_reviews}) AS rows_of_order
        GROUP BY order_id HAVING MAX(own) = 1""",
    "placed": """
        SELECT who.customer_unique_id, who.customer_state, l.*, COALESCE(l.sold, 0) AS revenue
        FROM {mk_customers} AS who, {ledger} AS l WHERE who.customer_id = l.customer_id""",
    "buyers": f"""
        SELECT customer_unique_id, {number(DONE)}::BIGINT AS delivered_orders FROM {{placed}}
        GROUP BY 1 HAVING MAX(CASE WHEN {DONE} THEN 1 ELSE 0 END) = 1""",
    "shelf": f"""
        SELECT kind.product_category_name_english AS category_name, line.order_id, COUNT(*) AS pieces,
               SUM(line.price) AS sold, SUM(line.freight_value) AS freight
        FROM {{mk_model_products}} AS kind, {{mk_items}} AS line
        WHERE kind.product_id = line.product_id AND line.order_id IN (SELECT order_id FROM {{ledger}} WHERE {DONE})
        GROUP BY 1, 2""",
    "stall": f"""
        SELECT seller_id, order_id, parts.sold, parts.freight, COALESCE({PUNCTUAL}, false) AS punctual, score
        FROM (SELECT seller_id, order_id, SUM(price) AS sold, SUM(freight_value) AS freight
              FROM {{mk_items}} GROUP BY ALL) AS parts
        JOIN (SELECT order_id, got, due, score FROM {{ledger}} WHERE {DONE}) AS done USING (order_id)""",
    "seen": f"""
        SELECT DISTINCT customer_unique_id, {MONTH} AS order_month,
               MIN({MONTH}) OVER (PARTITION BY customer_unique_id) AS cohort_month
        FROM {{placed}} WHERE {DONE}""",
    "an_executive": f"""
        SELECT CAST(MIN(bought) AS DATE) AS first_order_date, CAST(MAX(bought) AS DATE) AS last_order_date,
               COUNT(*) AS total_orders, {number(DONE)}::BIGINT AS delivered_orders,
               COUNT(DISTINCT customer_unique_id) AS unique_customers,
               (SELECT COUNT(DISTINCT seller_id) FROM {{stall}}) AS active_sellers,
               {money(GMV)} AS delivered_gmv, {ORDER_VALUE} AS delivered_average_order_value,
               {CANCELED} AS cancellation_rate_pct, {ON_TIME} AS on_time_delivery_rate_pct,
               {DAYS} AS average_delivery_days, {SCORE} AS average_review_score, {LOW} AS low_review_rate_pct,
               (SELECT {rate(number("delivered_orders > 1"), "COUNT(*)")} FROM {{buyers}})
                   AS repeat_customer_rate_pct
        FROM {{placed}}""",
    "an_monthly": f"""
        SELECT {MONTH} AS order_month, COUNT(*) AS total_orders, {number(DONE)}::BIGINT AS delivered_orders,
               {number("order_status = 'canceled'")}::BIGINT AS canceled_orders, {money(GMV)} AS delivered_gmv,
               {ORDER_VALUE} AS delivered_average_order_value, {CANCELED} AS cancellation_rate_pct,
               {ON_TIME} AS on_time_delivery_rate_pct, {DAYS} AS average_delivery_days,
               {SCORE} AS average_review_score
        FROM (SELECT *, COALESCE(sold, 0) AS revenue FROM {{ledger}}) AS l GROUP BY 1""",
    "an_category": f"""
        SELECT category_name, COUNT(*) AS delivered_orders, CAST(SUM(pieces) AS BIGINT) AS items_sold,
               {money("SUM(s.sold)")} AS delivered_gmv, {money("SUM(s.freight)")} AS freight_revenue,
               {each("SUM(s.sold)", "SUM(pieces)")} AS average_item_price, {SCORE} AS average_review_score
        FROM {{shelf}} AS s JOIN {{ledger}} AS l USING (order_id) GROUP BY category_name""",
    "an_state": f"""
        SELECT customer_state, COUNT(*) AS total_orders, {number(DONE)}::BIGINT AS delivered_orders,
               {money(f"SUM(CASE WHEN {DONE} THEN sold END)")} AS delivered_gmv,
               {CANCELED} AS cancellation_rate_pct, {ON_TIME} AS on_time_delivery_rate_pct,
               {SCORE} AS average_review_score
        FROM {{placed}} GROUP BY customer_state""",
    "an_payment": f"""
        SELECT payment_type, COUNT(*) AS payment_records, COUNT(DISTINCT order_id) AS orders_using_method,
               {money("SUM(payment_value)")} AS payment_value,
               {each("SUM(payment_value)", "COUNT(payment_value)")} AS average_payment_record_value,
               {hundredths("SUM(payment_installments)", "COUNT(payment_installments)")} AS average_installments,
               {rate("SUM(payment_value)", "(SELECT SUM(payment_value) FROM {mk_payments})")}
                   AS payment_value_share_pct
        FROM {{mk_payments}} GROUP BY payment_type""",
    "an_status": f"""
        SELECT order_status, COUNT(*) AS order_count,
               {rate("COUNT(*)", "(SELECT COUNT(*) FROM {mk_orders})")} AS order_share_pct
        FROM {{mk_orders}} GROUP BY order_status""",
    "an_delivery": f"""
        SELECT list_extract(['2+ days early', 'on time / 1 day early', '1–3 days late', '4–7 days late',
                             '8+ days late'], band_order) AS delivery_timing_band,
               band_order, COUNT(*) AS delivered_orders, {hundredths("SUM(delay)", "COUNT(*)")} AS average_delay_days,
               {SCORE} AS average_review_score, {LOW} AS low_review_rate_pct
        FROM (SELECT score, CAST(got AS DATE) - CAST(due AS DATE) AS delay,
                     (1 + (delay > -2)::INT + (delay > 0)::INT + (delay > 3)::INT + (delay > 7)::INT)::INT AS band_order
              FROM {{ledger}} WHERE {DATED}) AS late GROUP BY band_order""",
    "an_frequency": f"""
        SELECT band_order || CASE band_order WHEN 1 THEN ' order' WHEN 4 THEN '+ orders' ELSE ' orders' END
                   AS frequency_band,
               band_order, COUNT(*) AS customers,
               {rate("COUNT(*)", "(SELECT COUNT(*) FROM {buyers})")} AS customer_share_pct,
               {hundredths("SUM(delivered_orders)", "COUNT(*)")} AS average_delivered_orders
        FROM (SELECT delivered_orders, CASE WHEN delivered_orders > 3 THEN 4 ELSE delivered_orders END::INT
                         AS band_order FROM {{buyers}}) AS b GROUP BY band_order""",
    "an_cohorts": f"""
        SELECT cohort_month, month_number, first_value(active_customers) OVER w AS cohort_size, active_customers,
               {rate("active_customers", "first_value(active_customers) OVER w")} AS retention_rate_pct
        FROM (SELECT cohort_month, date_diff('month', cohort_month, order_month)::INT AS month_number,
                     COUNT(*) AS active_customers FROM {{seen}} GROUP BY 1, 2) AS active
        WINDOW w AS (PARTITION BY cohort_month ORDER BY month_number)""",
    "an_seller": f"""
        SELECT seller_id, seller_state, COUNT(*) AS delivered_orders, {money("SUM(sold)")} AS delivered_gmv,
               {each("SUM(sold)", "COUNT(*)")} AS average_order_revenue,
               {rate(number("punctual"), "COUNT(*)")} AS on_time_delivery_rate_pct,
               {SCORE} AS average_review_score, {LOW} AS low_review_rate_pct
        FROM {{stall}} JOIN {{mk_sellers}} USING (seller_id) GROUP BY seller_id, seller_state""",
}

_DATES = """CAST(bought AS VARCHAR) AS order_purchase_timestamp, CAST(got AS VARCHAR) AS order_delivered_customer_date,
               CAST(due AS VARCHAR) AS order_estimated_delivery_date"""

STATEMENTS = {
    "stg_01_review_by_order": "SELECT order_id, AVG(review_score) AS average_review_score FROM {mk_reviews} GROUP BY 1",
    "stg_02_order_value": """
        SELECT order_id, SUM(price)::DOUBLE AS item_revenue, SUM(freight_value)::DOUBLE AS freight_revenue
        FROM {mk_items} GROUP BY 1""",
    "stg_03_order_metrics": f"""
        SELECT order_id, customer_unique_id, order_status, {_DATES}, revenue::DOUBLE AS item_revenue,
               score AS average_review_score FROM {{placed}}""",
    "stg_04_delivered_customer_orders": "SELECT * FROM {buyers}",
    "stg_05_category_order": """
        SELECT category_name, order_id, pieces AS item_count, s.sold::DOUBLE AS item_revenue,
               s.freight::DOUBLE AS freight_revenue, score AS average_review_score
        FROM {shelf} AS s JOIN {ledger} AS l USING (order_id)""",
    "stg_06_seller_order": """
        SELECT seller_id, order_id, sold::DOUBLE AS item_revenue, freight::DOUBLE AS freight_revenue,
               punctual AS delivered_on_time, score AS average_review_score FROM {stall}""",
    "stg_07_cohorted_activity": """
        SELECT customer_unique_id, CAST(order_month AS VARCHAR) AS order_month,
               CAST(cohort_month AS VARCHAR) AS cohort_month FROM {seen}""",
    "ana_01_executive_summary": """
        SELECT * REPLACE (CAST(first_order_date AS VARCHAR) AS first_order_date,
                          CAST(last_order_date AS VARCHAR) AS last_order_date) FROM {an_executive}""",
    "ana_02_monthly_performance": """
        SELECT * REPLACE (CAST(order_month AS VARCHAR) AS order_month) FROM {an_monthly}""",
    "ana_03_category_performance": "SELECT * FROM {an_category}",
    "ana_04_state_performance": "SELECT * FROM {an_state}",
    "ana_05_payment_method_performance": "SELECT * FROM {an_payment}",
    "ana_06_order_status_distribution": "SELECT * FROM {an_status}",
    "ana_07_delivery_review_relationship": "SELECT * FROM {an_delivery}",
    "ana_08_customer_purchase_frequency": "SELECT * FROM {an_frequency}",
    "ana_09_monthly_customer_cohorts": """
        SELECT * REPLACE (CAST(cohort_month AS VARCHAR) AS cohort_month) FROM {an_cohorts}""",
    "ana_10_seller_scorecard": "SELECT * FROM {an_seller}",
}
