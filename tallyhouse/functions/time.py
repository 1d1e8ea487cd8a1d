"""Timestamp parsing and calendar arithmetic on zone-less timestamps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions import sql

CLOCK = r"([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"

# Accepted layouts of a date, each alone or with hours and minutes, seconds, and a fraction of up to nine digits (six are
# kept): the pattern of the date, and the replacement that puts it in year-month-day order.
LAYOUTS = {
    "yyyy-MM-dd": (r"^(\d{4})-(\d{2})-(\d{2})", "$1-$2-$3"),
    "yyyy/MM/dd": (r"^(\d{4})/(\d{2})/(\d{2})", "$1-$2-$3"),
    "dd/MM/yyyy": (r"^(\d{2})/(\d{2})/(\d{4})", "$3-$2-$1"),
    "MM/dd/yyyy": (r"^(\d{2})/(\d{2})/(\d{4})", "$3-$1-$2"),
}
STANDARD = "yyyy-MM-dd"
# Place and text of the first separator of each layout.
SEPARATORS = {"yyyy-MM-dd": (5, "-"), "yyyy/MM/dd": (5, "/"), "dd/MM/yyyy": (3, "/"), "MM/dd/yyyy": (3, "/")}


class AmbiguousLayout(ValueError):
    """Two layouts read the same number of values of a column, and read them differently."""


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_timestamp_sql(text: str, layout: str = STANDARD) -> str:
    """SQL text: a text as TIMESTAMP_NTZ, null where it does not follow the layout or is no real date."""
    date, order = LAYOUTS[layout]
    plain = text if layout == STANDARD else f"regexp_replace({text}, {sql.literal(date)}, '{order}')"
    return f"CASE WHEN {text} RLIKE {sql.literal(date + CLOCK)} THEN try_cast({plain} AS timestamp_ntz) END"


def layout_counts_sql(text: str) -> str:
    """SQL text of an aggregate: how many values each layout reads, as a map.

    A value is parsed only in the layouts whose first separator stands at its place, so mostly once or not at all.
    """
    counts = []
    for layout, (place, mark) in SEPARATORS.items():
        counts.append(f"'{layout}', count(CASE WHEN substring({text}, {place}, 1) = '{mark}' THEN {parse_timestamp_sql(text, layout)} END)")
    return f"map({', '.join(counts)})"


def winning_layout(counts: Mapping[str, int], column: str) -> str:
    """The layout that reads most values of a column; the standard one if none reads any."""
    most = max(counts.values(), default=0)
    best = [layout for layout in LAYOUTS if counts.get(layout) == most]
    if not most:
        return STANDARD
    if len(best) > 1:
        raise AmbiguousLayout(f"The values of {column} follow {' and '.join(best)} alike.")
    return best[0]


def parse_timestamp(column: str, layout: str = STANDARD) -> Column:
    """A text column as TIMESTAMP_NTZ."""
    return F.expr(parse_timestamp_sql(sql.name(column), layout))


def month_start(column: Column | str) -> Column:
    return F.trunc(_column(column).cast("date"), "MM")


def days_late(delivered: Column | str, estimated: Column | str) -> Column:
    """Whole calendar days between two timestamps."""
    return F.datediff(_column(delivered).cast("date"), _column(estimated).cast("date"))


def elapsed_microseconds(start: Column | str, end: Column | str) -> Column:
    """Elapsed time in microseconds."""
    return F.timestamp_diff("MICROSECOND", _column(start), _column(end))


def month_distance(later: Column | str, earlier: Column | str) -> Column:
    later, earlier = _column(later), _column(earlier)
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("int")
