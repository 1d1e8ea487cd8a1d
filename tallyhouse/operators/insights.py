"""Takeaways derived from the analyses and the audit."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import sql
from tallyhouse.functions.rounding import rate_pct
from tallyhouse.functions.rules import unpivot_row
from tallyhouse.operators.profile import Audit, column_quality, overview, timestamp_issues

# The months of the public data set that are complete.
CORE_WINDOW = (date(2017, 1, 1), date(2018, 8, 1))


def _number(column: str, digits: int = 0) -> str:
    return f"format_number({column}, {digits})"


def kpi_cards(summary: DataFrame, currency: str = "R$") -> DataFrame:
    """The executive summary as (position, metric, value) with formatted texts."""

    def money(column: str) -> str:
        return f"concat({sql.literal(currency)}, {_number(column, 2)})"

    def percent(column: str) -> str:
        return f"concat({_number(column, 2)}, '%')"

    period = "concat(CAST(first_order_date AS string), ' to ', CAST(last_order_date AS string))"
    # The card titles in their order.
    cards = [
        ("Observed period", period),
        ("Total orders", _number("total_orders")),
        ("Delivered orders", _number("delivered_orders")),
        ("Delivered GMV", money("delivered_gmv")),
        ("Delivered AOV", money("delivered_average_order_value")),
        ("Cancellation rate", percent("cancellation_rate_pct")),
        ("On-time delivery rate", percent("on_time_delivery_rate_pct")),
        ("Average delivery days", _number("average_delivery_days", 2)),
        ("Average review score", _number("average_review_score", 2)),
        ("Low-review rate", percent("low_review_rate_pct")),
        ("Repeat-customer rate", percent("repeat_customer_rate_pct")),
        ("Active sellers", _number("active_sellers")),
    ]
    return unpivot_row(
        summary,
        [
            {"position": str(i), "metric": sql.literal(title), "value": text}
            for i, (title, text) in enumerate(cards, start=1)
        ],
    )


def core_window(monthly: DataFrame, first: date = CORE_WINDOW[0], last: date = CORE_WINDOW[1]) -> DataFrame:
    """Months between two month starts, both included."""
    return monthly.filter(F.col("order_month").between(F.lit(first), F.lit(last))).orderBy("order_month")


def _leading(df: DataFrame, name: str, count: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_first("delivered_gmv"), F.asc_nulls_last(name)).limit(count)


def top_by_gmv(df: DataFrame, name: str, count: int = 10) -> DataFrame:
    """The leading rows by GMV, shown in ascending order."""
    return _leading(df, name, count).orderBy(F.asc("delivered_gmv"), name)


def cohort_cells(matrix: DataFrame) -> DataFrame:
    """The filled cells of a cohort matrix as rows: cohort, month, retention_rate_pct."""
    months = [name for name in matrix.columns if name != "cohort"]
    if not months:
        return matrix.select("cohort", F.lit("").alias("month"), F.lit(None).cast("double").alias("retention_rate_pct")).limit(0)
    return matrix.unpivot("cohort", months, "month", "retention_rate_pct").where("retention_rate_pct IS NOT NULL")


def cohort_matrix(cohorts: DataFrame, months: Iterable[int] | None = None) -> DataFrame:
    """Retention by cohort and month number; nobody active is null.

    ``months`` fixes the columns. Without it the largest month number is looked up first.
    """
    if months is None:
        last = cohorts.agg(F.max("month_number")).first()[0]
        months = range((last if last is not None else -1) + 1)
    numbers = list(months)
    matrix = (
        cohorts.groupBy(F.date_format("cohort_month", "yyyy-MM").alias("cohort"))
        .pivot("month_number", numbers)
        .agg(F.first("retention_rate_pct"))
    )
    return matrix.withColumnsRenamed({str(n): f"month_{n}" for n in numbers}).orderBy("cohort")


def peak_gmv_month(core: DataFrame) -> DataFrame:
    """Month with the highest GMV, the earliest one on a tie."""
    return (
        core.filter(F.col("delivered_gmv").isNotNull())
        .orderBy(F.desc("delivered_gmv"), "order_month")
        .limit(1)
        .select("order_month", "delivered_gmv")
    )


def worst_on_time_month(core: DataFrame) -> DataFrame:
    """Month with the lowest on-time rate, the earliest one on a tie."""
    return (
        core.filter(F.col("on_time_delivery_rate_pct").isNotNull())
        .orderBy("on_time_delivery_rate_pct", "order_month")
        .limit(1)
        .select("order_month", "on_time_delivery_rate_pct")
    )


def top_share(df: DataFrame, summary: DataFrame, name: str, count: int, alias: str) -> DataFrame:
    """Share of the leading rows in the delivered GMV, in percent."""
    total = summary.select("delivered_gmv").scalar()
    return _leading(df, name, count).agg(F.sum("delivered_gmv").alias("top")).select(
        rate_pct(F.col("top"), total).alias(alias)
    )


def very_late_band(bands: DataFrame) -> DataFrame:
    """Reviews of the latest deliveries."""
    return bands.filter(F.col("delivery_timing_band") == "8+ days late").select(
        "average_review_score", "low_review_rate_pct"
    )


def weighted_month_one_activity(cohorts: DataFrame) -> DataFrame:
    """Customers active one month after their first order, over the cohorts whose next month is observed."""
    latest = cohorts.select(F.max(F.add_months("cohort_month", F.col("month_number")))).scalar()
    month_one = cohorts.groupBy("cohort_month").agg(
        F.max("cohort_size").alias("cohort_size"),
        F.sum(F.when(F.col("month_number") == 1, F.col("active_customers"))).alias("active"),
    )
    observed = month_one.filter(F.add_months("cohort_month", 1) <= latest)
    return observed.agg(
        F.count("*").alias("cohorts"),
        F.sum("cohort_size").alias("customers"),
        F.coalesce(F.sum("active"), F.lit(0)).alias("active_customers"),
    ).select(
        "cohorts",
        "customers",
        "active_customers",
        rate_pct(F.col("active_customers"), F.col("customers")).alias("month_one_activity_pct"),
    )


def slice_months(monthly: DataFrame, first: date, last: date) -> DataFrame:
    """GMV trend inside a month range."""
    return core_window(monthly, first, last).select("order_month", "delivered_gmv")


def slice_states(states: DataFrame, chosen: list[str]) -> DataFrame:
    """Markets of the chosen customer states."""
    return states.filter(F.col("customer_state").isin(*chosen))


# Views on the audit reports.


def columns_with_gaps(audit: Audit) -> DataFrame:
    return (
        column_quality(audit)
        .filter(F.col("missing_values") > 0)
        .orderBy(F.desc("missing_percent"), "file_name", "column_name")
    )


def overview_by_rows(audit: Audit) -> DataFrame:
    return overview(audit).orderBy(F.desc("rows"), "file_name")


def overview_by_duplicates(audit: Audit) -> DataFrame:
    return (
        overview(audit)
        .select("file_name", "duplicate_rows", "likely_primary_keys", "quality_warnings")
        .orderBy(F.desc("duplicate_rows"), "file_name")
    )


def timestamps_by_problems(audit: Audit) -> DataFrame:
    return timestamp_issues(audit).orderBy(F.desc("invalid_values"), "file_name", "column_name")


def issues_by_file(issues: DataFrame) -> DataFrame:
    return issues.orderBy("file_name", "issue_type", "message")


def rules_by_status(rules: DataFrame) -> DataFrame:
    return rules.orderBy("status", F.desc("violation_rows"), "rule_name")
