"""SQL text building blocks.

Wide rule lists are handed to Spark as SQL expressions: one call per expression instead of one per operator.
"""

from __future__ import annotations


def literal(value: str) -> str:
    """A text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def percent(top: str, bottom: str, empty: float = 0.0) -> str:
    """100 * top / bottom with four decimals, half to even; ``empty`` where nothing was counted."""
    share = f"CAST({top} AS double) / nullif(CAST({bottom} AS double), 0.0D) * 100"
    return f"coalesce(CAST(bround(CAST({share} AS decimal(28,12)), 4) AS double), {empty}D)"
