"""Exact rounding.

Rates and means are rounded once, half away from zero, on whole numbers. Report percentages are rounded half to even, four decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions import sql


def round_money(value: Column) -> Column:
    """Two decimals on an exact money sum."""
    return F.round(value, 2)


def round_ratio(numerator: Column, denominator: Column, places: int = 0, scale: int = 1) -> Column:
    """scale * numerator / denominator with two decimals, half away from zero; null for a zero denominator.

    Both sides become whole numbers (the numerator has ``places`` decimals), so no digit is rounded twice: the result
    is the whole part of (200 * scale * numerator + denominator) / (2 * denominator) hundredths.
    """
    whole = "decimal(38,0)"
    top = (numerator.cast(f"decimal(38,{places})") * F.lit(10**places).cast(whole)).cast(whole)
    bottom = F.nullif(denominator.cast("decimal(38,0)") * F.lit(10**places).cast(whole), F.lit(0).cast(whole)).cast(whole)
    doubled = (F.abs(top) * F.lit(200 * scale).cast(whole) + bottom).cast(whole)
    twice = (bottom * F.lit(2).cast(whole)).cast(whole)
    hundredths = ((doubled - doubled % twice) / twice).cast("decimal(38,0)")
    return (F.signum(top) * hundredths.cast("double") / F.lit(100.0)).cast("double")


def rate_pct(numerator: Column, denominator: Column) -> Column:
    """100 * numerator / denominator, two decimals; both are counts or amounts with two decimals."""
    cents = lambda value: (value.cast("decimal(38,2)") * F.lit(100).cast("decimal(38,0)")).cast("decimal(38,0)")
    return round_ratio(cents(numerator), cents(denominator), scale=100)


def report_percent(numerator: str, denominator: str, empty: float = 0.0) -> Column:
    """100 * numerator / denominator, four decimals half to even; ``empty`` where nothing was counted."""
    return F.expr(sql.percent(numerator, denominator, empty))
