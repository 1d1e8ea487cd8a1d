"""Text normalising."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import sql

# The characters counted as white space around a text value.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0            "
    "    　"
)

# Texts of a CSV field that mean "missing".
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def stripped_sql(text: str) -> str:
    """SQL text: surrounding white space (Unicode included) removed, blank text turned into null.

    Trimming by a character set walks the whole value, so it is left to values whose first or last character is
    a blank, a control character or not ASCII; two byte comparisons tell.
    """
    last = f"substring({text}, -1, 1)"
    suspect = " OR ".join(f"{end} < '!' OR {end} >= '\u0080'" for end in (text, last))
    return f"nullif(if({suspect}, btrim({text}, {sql.literal(WHITE_SPACE)}), {text}), '')"


def stripped(column: str) -> Column:
    """A text column stripped; blank becomes null."""
    return F.expr(stripped_sql(sql.name(column)))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def replace_columns(df: DataFrame, replacements: dict[str, Column]) -> DataFrame:
    """One projection that replaces (or appends) columns and keeps the order."""
    return df.withColumns(replacements) if replacements else df


def strip_text(df: DataFrame) -> DataFrame:
    """Every text column stripped; blank becomes null."""
    return replace_columns(df, {name: stripped(name) for name in text_columns(df)})


def missing_tokens_to_null(df: DataFrame) -> DataFrame:
    """Fields of a raw CSV that hold a missing-value token become null."""
    tokens = ", ".join(sql.literal(token) for token in MISSING_TOKENS)
    return replace_columns(
        df,
        {c: F.expr(f"CASE WHEN {sql.name(c)} NOT IN ({tokens}) THEN {sql.name(c)} END") for c in text_columns(df)},
    )
