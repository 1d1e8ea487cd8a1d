"""Expected results of the takeaways."""

from __future__ import annotations

from tallyhouse.oracle.analyses import rate

# Months of the test data used as the core window.
FIRST, LAST = "1993-01-01", "1996-08-01"

LEADING = "ORDER BY delivered_gmv DESC NULLS FIRST, {name} LIMIT {count}"


def top(view: str, name: str, count: int) -> str:
    return f"SELECT * FROM {{{view}}} {LEADING.format(name=name, count=count)}"


def share(view: str, name: str, count: int, alias: str) -> str:
    leading = f"(SELECT SUM(delivered_gmv) FROM ({top(view, name, count)}) AS t)"
    return f"SELECT {rate(leading, 'delivered_gmv')} AS {alias} FROM {{an_executive}}"


def card(position: int, metric: str, value: str) -> str:
    return f"SELECT {position} AS position, '{metric}' AS metric, {value} AS value FROM {{an_executive}}"


def count(column: str) -> str:
    return f"format('{{:,}}', {column})"


def decimals(column: str, before: str = "", after: str = "") -> str:
    return f"format('{before}{{:,.2f}}{after}', {column})"


CARDS = "\nUNION ALL\n".join(
    [
        card(1, "Observed period", "concat(CAST(first_order_date AS VARCHAR), ' to ', CAST(last_order_date AS VARCHAR))"),
        card(2, "Total orders", count("total_orders")),
        card(3, "Delivered orders", count("delivered_orders")),
        card(4, "Delivered GMV", decimals("delivered_gmv", "R$")),
        card(5, "Delivered AOV", decimals("delivered_average_order_value", "R$")),
        card(6, "Cancellation rate", decimals("cancellation_rate_pct", after="%")),
        card(7, "On-time delivery rate", decimals("on_time_delivery_rate_pct", after="%")),
        card(8, "Average delivery days", decimals("average_delivery_days")),
        card(9, "Average review score", decimals("average_review_score")),
        card(10, "Low-review rate", decimals("low_review_rate_pct", after="%")),
        card(11, "Repeat-customer rate", decimals("repeat_customer_rate_pct", after="%")),
        card(12, "Active sellers", count("active_sellers")),
    ]
)

STAGE_VIEWS = {
    "an_core": f"SELECT * FROM {{an_monthly}} WHERE order_month BETWEEN DATE '{FIRST}' AND DATE '{LAST}'",
}

STATEMENTS = {
    "eda_01_kpi_cards": CARDS,
    "eda_02_core_window": "SELECT * REPLACE (CAST(order_month AS VARCHAR) AS order_month) FROM {an_core}",
    "eda_03_top_categories": top("an_category", "category_name", 10),
    "eda_04_top_states": top("an_state", "customer_state", 10),
    "eda_05_cohort_matrix": """
        SELECT strftime(cohort_month, '%Y-%m') AS cohort, 'month_' || month_number AS month, retention_rate_pct
        FROM {an_cohorts}""",
    "eda_06_peak_gmv_month": """
        SELECT CAST(order_month AS VARCHAR) AS order_month, delivered_gmv FROM {an_core}
        ORDER BY delivered_gmv DESC NULLS LAST, order_month LIMIT 1""",
    "eda_07_worst_on_time_month": """
        SELECT CAST(order_month AS VARCHAR) AS order_month, on_time_delivery_rate_pct FROM {an_core}
        WHERE on_time_delivery_rate_pct IS NOT NULL ORDER BY 2, 1 LIMIT 1""",
    "eda_08_top_five_category_share": share("an_category", "category_name", 5, "top_five_category_share_pct"),
    "eda_09_top_three_state_share": share("an_state", "customer_state", 3, "top_three_state_share_pct"),
    "eda_10_very_late_band": """
        SELECT average_review_score, low_review_rate_pct FROM {an_delivery} WHERE band_order = 5""",
    "eda_13_slice_months": "SELECT CAST(order_month AS VARCHAR) AS order_month, delivered_gmv FROM {an_core}",
    "eda_13_slice_states": "SELECT * FROM {an_state} WHERE customer_state IN ('BRAZIL', 'FRANCE', 'NATION_3')",
    "eda_14_weighted_month_one_activity": f"""
        SELECT COUNT(*) AS cohorts, CAST(SUM(size) AS BIGINT) AS customers,
               CAST(SUM(active) AS BIGINT) AS active_customers,
               {rate("SUM(active)", "SUM(size)")} AS month_one_activity_pct
        FROM (SELECT cohort_month, MAX(cohort_size) AS size,
                     COALESCE(SUM(active_customers) FILTER (WHERE month_number = 1), 0) AS active
              FROM {{an_cohorts}} GROUP BY cohort_month) AS c
        WHERE cohort_month + INTERVAL 1 MONTH
              <= (SELECT MAX(cohort_month + INTERVAL 1 MONTH * month_number) FROM {{an_cohorts}})""",
    "eda_15_top_ten_category_share": share("an_category", "category_name", 10, "top_ten_category_share_pct"),
}
