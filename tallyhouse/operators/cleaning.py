"""Conservative cleaning: rows stay, values are normalised and doubts become ``dq_*`` flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.contracts import INTEGER, MARKETPLACE, MONEY, NUMBER, SEQUENCE_FLAGS, TIMESTAMP, ContractSet
from tallyhouse.functions import sql
from tallyhouse.functions.rules import unpivot_row
from tallyhouse.functions.text import replace_columns, strip_text, stripped
from tallyhouse.functions.time import STANDARD, AmbiguousLayout, layout_counts_sql, parse_timestamp, winning_layout


class CleaningError(ValueError):
    """The input cannot be cleaned without losing values."""


@dataclass(frozen=True)
class Cleaned:
    """A cleaned table and the texts of the rules that were applied to it.

    ``{removed}`` in a text stands for the number of removed rows, known once the table is written.
    """

    frame: DataFrame
    rules: tuple[str, ...]


def _require(df: DataFrame, columns: Iterable[str], label: str, kind: str) -> None:
    for column in columns:
        if column not in df.columns:
            raise CleaningError(f"{label} lacks the {kind} column {column!r}.")


def numeric_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, invalid_values): populated values that are no number, for all columns in one pass."""
    counters = []
    for i, column in enumerate(columns):
        value = sql.name(column)
        counters.append(f"count_if({value} IS NOT NULL AND try_cast({value} AS double) IS NULL) AS v{i}")
    return unpivot_row(
        df.selectExpr(*counters),
        [{"column_name": sql.literal(c), "invalid_values": f"v{i}"} for i, c in enumerate(columns)],
    )


def coerce_numeric(df: DataFrame, columns: list[str], label: str, strict: bool = True) -> DataFrame:
    """Declared numeric columns as double.

    With ``strict`` one aggregate counts unconvertible values first and any of them stops the run; without it
    they become null.
    """
    _require(df, columns, label, "numeric")
    if strict and columns:
        for row in numeric_violations(df, columns).filter("invalid_values > 0").collect():
            raise CleaningError(
                f"{label}: column {row.column_name!r} holds {row.invalid_values} value(s) that are no numbers."
            )
    return replace_columns(df, {column: F.col(column).try_cast("double") for column in columns})


def timestamp_layouts(df: DataFrame, columns: list[str], label: str) -> dict[str, str]:
    """Layout of each text column by the number of values that it reads, from one aggregate over all columns.

    A column whose values follow two layouts alike stops the run, since each value would have two readings.
    """
    _require(df, columns, label, "timestamp")
    texts = [column for column in columns if dict(df.dtypes)[column] == "string"]
    if not texts:
        return {}
    row = df.selectExpr(*[f"{layout_counts_sql(sql.name(column))} AS c{i}" for i, column in enumerate(texts)]).first()
    try:
        return {column: winning_layout(counts, column) for column, counts in zip(texts, row, strict=True)}
    except AmbiguousLayout as error:
        raise CleaningError(f"{label}: {error}") from error


def parse_timestamps(df: DataFrame, columns: list[str], label: str, layouts: Mapping[str, str] | None = None) -> DataFrame:
    """Declared timestamps parsed; ``dq_invalid_<column>`` marks populated values that are none in the column's layout."""
    _require(df, columns, label, "timestamp")
    parsed = {column: parse_timestamp(column, (layouts or {}).get(column, STANDARD)) for column in columns}
    flags = {f"dq_invalid_{column}": F.col(column).isNotNull() & value.isNull() for column, value in parsed.items()}
    return df.withColumns({**flags, **parsed})


def add_sequence_flags(df: DataFrame) -> DataFrame:
    """Flags for timestamps that run backwards, and their disjunction; never null."""
    flags = {
        flag: F.coalesce(F.col(earlier) > F.col(later), F.lit(False))
        for flag, (earlier, later) in SEQUENCE_FLAGS.items()
    }
    flagged = df.withColumns(flags)
    anything = F.lit(False)
    for flag in flags:
        anything = anything | F.col(flag)
    return flagged.withColumn("dq_has_timestamp_sequence_issue", anything)


def lower_values(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.lower(column))


def add_negative_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    """``dq_negative_<column>``; null is not negative."""
    return df.withColumns({f"dq_negative_{c}": F.coalesce(F.col(c) < 0, F.lit(False)) for c in columns})


def add_review_range_flag(df: DataFrame) -> DataFrame:
    """Score outside 1..5; a missing score is flagged as well."""
    inside = F.coalesce(F.col("review_score").between(1, 5), F.lit(False))
    return df.withColumn("dq_review_score_out_of_range", ~inside)


def translate_categories(products: DataFrame, translation: DataFrame | None) -> DataFrame:
    """English category with the source name and ``unknown`` as fallbacks, and two flags.

    The translation is joined without a hint: Spark broadcasts it while its measured size allows and otherwise
    shuffles, splitting a category that fills a partition.
    """
    if translation is None:
        raise CleaningError("Products need the category translation table.")
    names = strip_text(translation).select(
        F.col("product_category_name").alias("translated_name"),
        F.col("product_category_name_english").alias("translation"),
    )
    repeated = names.groupBy("translated_name").agg(F.count("*").alias("n")).where("n > 1 AND translated_name IS NOT NULL")
    twice = repeated.agg(F.min("translated_name")).first()[0]
    if twice is not None:
        raise CleaningError(f"The category translation names '{twice}' more than once, apart from white space.")
    category, english = F.col("product_category_name"), F.col("translation")
    return (
        products.join(names, category == F.col("translated_name"), "left")
        .withColumns(
            {
                "dq_category_missing": category.isNull(),
                "dq_category_translation_missing": category.isNotNull() & english.isNull(),
                "product_category_name_english": F.coalesce(english, category, F.lit("unknown")),
            }
        )
        .drop("translated_name", "translation")
    )


def correct_product_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(
        {
            "product_name_lenght": "product_name_length",
            "product_description_lenght": "product_description_length",
        }
    )


def remove_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def promote_untranslated(translation: DataFrame, products: DataFrame) -> DataFrame:
    """Translation table plus the product categories it lacks, labelled with their own name and flagged."""
    known = translation.select("product_category_name").filter(F.col("product_category_name").isNotNull())
    fallback = (
        products.select("product_category_name")
        .filter(F.col("product_category_name").isNotNull())
        .distinct()
        .join(known, "product_category_name", "left_anti")
        .select(
            "product_category_name",
            F.col("product_category_name").alias("product_category_name_english"),
            F.lit(True).alias("dq_translation_missing"),
        )
    )
    return (
        translation.withColumn("dq_translation_missing", F.lit(False))
        .unionByName(fallback)
        .orderBy(F.asc_nulls_last("product_category_name"))
    )


# Texts that name the applied rules in the lineage.
TEXT_RULES = ("trimmed surrounding text whitespace", "standardized blank text as missing")
NUMERIC_RULE = "validated and converted declared numeric columns"
TIMESTAMP_RULE = "parsed declared timestamps and added invalid-value flags"
ORDER_RULES = (
    "normalized order_status to lowercase",
    "added non-destructive timestamp-sequence quality flags",
)
ITEM_RULES = ("added non-negative monetary-value flags",)
PAYMENT_RULES = ("normalized payment_type to lowercase", "added payment-domain quality flags")
REVIEW_RULES = ("added review-score domain flag",)
PRODUCT_RULES = (
    "added English category with source-name and unknown fallbacks",
    "added missing-category and missing-translation flags",
    "corrected processed product length column spellings",
)
GEOLOCATION_RULES = ("removed {removed} exact duplicate observation(s)",)
CATEGORY_RULES = (
    "added untranslated source categories with transparent fallback labels",
    "added missing-translation quality flag",
)
LOOKUP_RULES = (
    "aggregated to one row per ZIP-code prefix",
    "used median coordinates from unique observations",
    "selected most frequent city/state pair with deterministic tie-breaking",
    "added source-observation and geographic-variant quality counts",
)


def clean_source_table(
    df: DataFrame,
    table: str,
    category_translation: DataFrame | None = None,
    contracts: ContractSet = MARKETPLACE,
    strict: bool = True,
) -> Cleaned:
    """Clean one source table by its contract; a table outside the contract is only stripped."""
    if not table.strip():
        raise CleaningError("A table name is required.")
    label = contracts.file_name(table)
    contract = contracts.sources.get(table)
    numeric = contract.of_kind(INTEGER, NUMBER, MONEY) if contract else []
    timestamps = contract.of_kind(TIMESTAMP) if contract else []
    rules = list(TEXT_RULES)
    cleaned = strip_text(df)
    if numeric:
        cleaned = coerce_numeric(cleaned, numeric, label, strict)
        rules.append(NUMERIC_RULE)
    if timestamps:
        layouts = timestamp_layouts(cleaned, timestamps, label) if strict else None
        cleaned = parse_timestamps(cleaned, timestamps, label, layouts)
        rules.append(TIMESTAMP_RULE)

    if table == "orders":
        cleaned = cleaned.transform(lower_values, "order_status").transform(add_sequence_flags)
        rules += ORDER_RULES
    elif table == "order_items":
        cleaned = add_negative_flags(cleaned, ["price", "freight_value"])
        rules += ITEM_RULES
    elif table == "order_payments":
        cleaned = cleaned.transform(lower_values, "payment_type").transform(
            add_negative_flags, ["payment_value", "payment_installments"]
        )
        rules += PAYMENT_RULES
    elif table == "order_reviews":
        cleaned = add_review_range_flag(cleaned)
        rules += REVIEW_RULES
    elif table == "products":
        cleaned = cleaned.transform(translate_categories, category_translation).transform(correct_product_columns)
        rules += PRODUCT_RULES
    elif table == "geolocation":
        cleaned = remove_exact_duplicates(cleaned)
        rules += GEOLOCATION_RULES
    return Cleaned(cleaned, tuple(rules))


def normalised_zip(source: DataFrame, column: str) -> DataFrame:
    """The raw zip column as the cleaner would read it."""
    value = stripped(column) if dict(source.dtypes)[column] == "string" else F.col(column)
    return source.select(value.try_cast("double").alias(column))
