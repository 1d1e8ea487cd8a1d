"""Profile of any table: shape, types, gaps, duplicates, candidate keys, timestamp problems, warnings.

One statistics pass over the text columns of a table and one over the others count all columns and sketch the distinct values of those named like a key. Only
columns that may be keys by their sketch are counted exactly. Everything else is derived from small results.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tallyhouse.functions import sql
from tallyhouse.functions.rounding import report_percent
from tallyhouse.functions.rules import empty_frame, union_all, unpivot_row
from tallyhouse.functions.text import stripped_sql, text_columns
from tallyhouse.functions.time import LAYOUTS, STANDARD, layout_counts_sql, parse_timestamp_sql

# Names that suggest a key or a timestamp.
KEY_NAME = re.compile(r"(?:^id$|_id$)", re.IGNORECASE)
TIMESTAMP_NAME = re.compile(r"(?:date|time|timestamp|_at$)", re.IGNORECASE)

# Text of one column is typed by the narrowest layout all its values follow.
NUMBER_LAYOUT = r"^\s*+[+-]?+(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+\s*$"
INTEGER, NUMBER, BOOLEAN = 1, 2, 4
BOOLEAN_TEXTS = ("True", "False", "TRUE", "FALSE", "true", "false")

EXAMPLE_LIMIT = 5
# A sketch of 2 ** 12 registers is off by 1.6 % (one standard deviation); a key may read 15 % low and is still counted.
SKETCH_BITS = 12
KEY_SHARE = 0.85
NARROW_ROW = 64

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Audit:
    """The measured frames of a set of tables, all of them small.

    columns:    file_name, position, column_name, inferred_type, row_count, missing_values,
                timestamp_values, invalid_timestamps, layout_values: how many values each timestamp layout reads
                (null unless a timestamp-like text column),
                distinct_estimate (null unless named like a key)
    duplicates: file_name, duplicate_rows
    keys:       file_name, column_name
    examples:   file_name, column_name, invalid_examples

    The last three are measured when a report first asks for them.
    """

    columns: DataFrame
    measures: Mapping[str, Callable[[], DataFrame]]

    @cached_property
    def duplicates(self) -> DataFrame:
        return self.measures["duplicates"]()

    @cached_property
    def keys(self) -> DataFrame:
        return self.measures["keys"]()

    @cached_property
    def examples(self) -> DataFrame:
        return self.measures["examples"]()

    def parts(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in ("columns", "duplicates", "keys", "examples")}

    def stored(self, spark: SparkSession, folder: str) -> Audit:
        """The same audit read back from files, so that several reports do not measure twice."""
        stored = {}
        for name, frame in self.parts().items():
            frame.write.mode("overwrite").parquet(f"{folder}/{name}")
            stored[name] = spark.read.schema(frame.schema).parquet(f"{folder}/{name}")
        return Audit(stored.pop("columns"), {name: lambda frame=frame: frame for name, frame in stored.items()})


def _kind_sql(value: str) -> str:
    """SQL text: the types that a text follows as bits, null for null.

    The pattern of numbers is left to texts that start like one and have no minus after a digit, as dates do. A number without
    a point or an exponent has the layout of an integer.
    """
    booleans = ", ".join(sql.literal(text) for text in BOOLEAN_TEXTS)
    plain = " AND ".join(f"NOT contains({value}, '{mark}')" for mark in ".eE")
    return (
        f"CASE WHEN {value} >= ':' THEN CASE WHEN {value} IN ({booleans}) THEN {BOOLEAN} ELSE 0 END "
        f"WHEN substring({value}, 5, 1) = '-' AND substring({value}, 4, 1) BETWEEN '0' AND '9' THEN 0 "
        f"WHEN {value} RLIKE {sql.literal(NUMBER_LAYOUT)} THEN "
        f"CASE WHEN {plain} AND try_cast(trim({value}) AS bigint) IS NOT NULL THEN {NUMBER | INTEGER} ELSE {NUMBER} END "
        f"WHEN {value} IS NOT NULL THEN 0 END"
    )


def _typed_statistics(df: DataFrame, label: str, fields: list[tuple[int, T.StructField]]) -> DataFrame:
    """Statistics of columns that are not text, from one aggregate over the table."""
    counters, records = ["count(1) AS row_count"], []
    for i, field in fields:
        value = sql.name(field.name)
        counters.append(f"count({value}) AS filled{i}")
        is_key = KEY_NAME.search(field.name)
        if is_key:
            counters.append(f"hll_sketch_estimate(hll_sketch_agg(CAST({value} AS string), {SKETCH_BITS})) AS distinct{i}")
        records.append(
            {
                "file_name": sql.literal(label),
                "position": str(i),
                "column_name": sql.literal(field.name),
                "inferred_type": sql.literal(field.dataType.simpleString()),
                "row_count": "row_count",
                "missing_values": f"row_count - filled{i}",
                "timestamp_values": "CAST(NULL AS bigint)",
                "invalid_timestamps": "CAST(NULL AS bigint)",
                "layout_values": "CAST(NULL AS map<string,bigint>)",
                "distinct_estimate": f"distinct{i}" if is_key else "CAST(NULL AS bigint)",
            }
        )
    return unpivot_row(df.selectExpr(*counters), records)


def _text_statistics(df: DataFrame, label: str, fields: list[tuple[int, T.StructField]]) -> DataFrame:
    """Statistics of text columns.

    Each row becomes one (position, value) row per column, so the code that judges a text is the same for all columns. Repeated
    for each, it would outgrow what the JVM compiles, and be interpreted.
    """
    keys = [i for i, field in fields if KEY_NAME.search(field.name)]
    times = [i for i, field in fields if TIMESTAMP_NAME.search(field.name)]
    among = lambda places: f"position IN ({', '.join(map(str, places))})" if places else "false"
    pairs = ", ".join(f"named_struct('position', {i}, 'value', {sql.name(field.name)})" for i, field in fields)
    judged = df.selectExpr(f"inline(array({pairs}))").selectExpr(
        "position",
        f"{_kind_sql('value')} AS kind",
        f"if({among(keys)}, value, NULL) AS key",
        f"if({among(times)}, {stripped_sql('value')}, NULL) AS text",
    )
    measures = [F.count("*").alias("row_count"), F.count("kind").alias("filled"), F.expr("bit_and(kind) AS kinds")]
    if keys:
        measures.append(F.expr(f"hll_sketch_estimate(hll_sketch_agg(key, {SKETCH_BITS})) AS distinct"))
    if times:
        measures += [F.count("text").alias("stamps"), F.expr(f"{layout_counts_sql('text')} AS layouts")]
    counted = judged.groupBy("position").agg(*measures)
    names = df.sparkSession.createDataFrame([(i, field.name) for i, field in fields], "place int, column_name string")
    layouts = "map(" + ", ".join(f"'{layout}', 0L" for layout in LAYOUTS) + ")"
    stamps = f"if({among(times)}, %s, NULL)" if times else "CAST(NULL AS bigint)"
    # The bits that all values of a column have in common tell its type. An empty table has no counts.
    return names.join(counted, F.expr("place = position"), "left").drop("position").withColumnRenamed("place", "position").selectExpr(
        f"{sql.literal(label)} AS file_name",
        "position",
        "column_name",
        f"CASE WHEN coalesce(filled, 0) = 0 THEN 'double' WHEN kinds & {INTEGER} <> 0 THEN 'bigint' "
        f"WHEN kinds & {NUMBER} <> 0 THEN 'double' WHEN kinds & {BOOLEAN} <> 0 THEN 'boolean' ELSE 'string' END AS inferred_type",
        "coalesce(row_count, 0) AS row_count",
        "coalesce(row_count - filled, 0) AS missing_values",
        (stamps % "coalesce(stamps, 0)" if times else stamps) + " AS timestamp_values",
        # What the winning layout does not read is invalid.
        (stamps % "coalesce(stamps - array_max(map_values(layouts)), 0)" if times else stamps) + " AS invalid_timestamps",
        (stamps % f"coalesce(layouts, {layouts})" if times else "CAST(NULL AS map<string,bigint>)") + " AS layout_values",
        (f"if({among(keys)}, coalesce(distinct, 0), NULL)" if keys else "CAST(NULL AS bigint)") + " AS distinct_estimate",
    )


def column_statistics(df: DataFrame, label: str) -> DataFrame:
    """One row per column: one aggregate over the text columns of the table, one over its others."""
    if not label.strip():
        raise ValueError("The table label must be a non-empty text.")
    texts, others = [], []
    for i, field in enumerate(df.schema.fields, start=1):
        (texts if isinstance(field.dataType, T.StringType) else others).append((i, field))
    parts = [part(df, label, fields) for part, fields in ((_text_statistics, texts), (_typed_statistics, others)) if fields]
    return union_all(parts)


def _row_digest_sql(df: DataFrame) -> str:
    """SHA-256 of all values; lengths and null marks keep different rows apart."""
    parts = []
    for field in df.schema.fields:
        value = sql.name(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = f"({value} + CAST(0 AS {field.dataType.simpleString()}))"
        text = f"CAST({value} AS string)"
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            text = f"to_json(struct({value} AS v), map('timestampNTZFormat', 'yyyy-MM-dd HH:mm:ss.SSSSSS'))"
        parts.append(f"coalesce(concat(length({text}), ':', {text}), 'n')")
    return f"unhex(sha2(concat({', '.join(parts)}), 256))"


def duplicate_rows(df: DataFrame, label: str) -> DataFrame:
    """Rows equal to another, earlier counted row over all columns: rows minus distinct rows, nulls equal.

    Wide rows are grouped by a SHA-256 of their values, so the shuffle moves 32 bytes for each distinct row of
    a task instead of the row itself. Copies combine before the shuffle either way.
    """
    fixed_width = all(
        not isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))
        for f in df.schema.fields
    )
    if fixed_width and len(df.columns) * 8 <= NARROW_ROW:
        groups = df.groupBy(*[sql.name(c) for c in df.columns]).agg(F.count("*").alias("n_rows"))
    else:
        groups = df.selectExpr(f"{_row_digest_sql(df)} AS digest").groupBy("digest").agg(F.count("*").alias("n_rows"))
    return groups.selectExpr(
        f"{sql.literal(label)} AS file_name", "coalesce(sum(n_rows - 1), 0) AS duplicate_rows"
    )


def _as_pairs(df: DataFrame, names: list[str], text: Callable[[str], str]) -> DataFrame:
    """(column_name, value) rows of several columns."""
    pairs = [f"named_struct('column_name', {sql.literal(n)}, 'value', {text(sql.name(n))})" for n in names]
    return df.selectExpr(f"inline(array({', '.join(pairs)}))")


def possible_keys(statistics: DataFrame) -> dict[str, list[str]]:
    """Columns by table that may be keys: populated, without nulls, and by their sketch about as many values as rows."""
    screened = statistics.filter("row_count > 0 AND missing_values = 0").filter(F.col("distinct_estimate") >= KEY_SHARE * F.col("row_count"))
    found: dict[str, list[str]] = {}
    for row in screened.orderBy("file_name", "position").collect():
        found.setdefault(row.file_name, []).append(row.column_name)
    return found


def distinct_columns(df: DataFrame, label: str, names: list[str]) -> DataFrame:
    """Those of the columns whose values are all different and not null, counted exactly in one grouped pass."""
    values = _as_pairs(df, names, lambda column: f"CAST({column} AS string)")
    groups = values.groupBy("column_name", "value").agg(F.count("*").alias("n_rows"))
    return (
        groups.groupBy("column_name")
        .agg(F.expr("max(n_rows) AS most"), F.expr("count_if(value IS NULL) AS null_groups"))
        .filter("most = 1 AND null_groups = 0")
        .selectExpr(f"{sql.literal(label)} AS file_name", "column_name")
    )


def candidate_keys(tables: Tables, statistics: DataFrame) -> DataFrame:
    """Columns named like an id that are never null and all distinct; none for an empty table.

    The sketches of the statistics pass leave few columns, mostly real keys, to be counted.
    """
    counted = [distinct_columns(tables[label], label, names) for label, names in possible_keys(statistics).items()]
    return union_all(counted) if counted else empty_frame(statistics.sparkSession, "file_name string, column_name string")


def invalid_timestamp_examples(
    df: DataFrame, label: str, example_limit: int = EXAMPLE_LIMIT, layouts: Mapping[str, str] | None = None
) -> DataFrame:
    """Up to ``example_limit`` distinct unparseable texts per timestamp-like column, in alphabetical order.

    Only distinct bad texts are ranked, and the rank filter already runs before the shuffle.
    """
    if example_limit < 1:
        raise ValueError("example_limit must be at least 1.")
    names = [name for name in text_columns(df) if TIMESTAMP_NAME.search(name)]
    if not names:
        return empty_frame(df.sparkSession, "file_name string, column_name string, invalid_examples string")
    bad_text = lambda name: (
        f"if(({parse_timestamp_sql(stripped_sql(sql.name(name)), (layouts or {}).get(name, STANDARD))}) IS NULL, {stripped_sql(sql.name(name))}, NULL)"
    )
    pairs = [f"named_struct('column_name', {sql.literal(n)}, 'value', {bad_text(n)})" for n in names]
    bad = df.selectExpr(f"inline(array({', '.join(pairs)}))").filter("value IS NOT NULL").distinct()
    position = F.row_number().over(W.partitionBy("column_name").orderBy("value"))
    return (
        bad.withColumn("place", position)
        .filter(F.col("place") <= example_limit)
        .groupBy("column_name")
        .agg(F.expr("array_join(array_sort(collect_list(value)), ' | ') AS invalid_examples"))
        .selectExpr(f"{sql.literal(label)} AS file_name", "column_name", "invalid_examples")
    )


def timestamp_layouts(audit: Audit) -> DataFrame:
    """(file_name, column_name, layout, layout_count, is_mixed): the layouts that read values of a column.

    A column is mixed if a second layout reads values that the one with most of them does not.
    """
    read = audit.columns.select("file_name", "column_name", "timestamp_values", F.explode("layout_values").alias("layout", "layout_count"))
    most = F.max("layout_count").over(W.partitionBy("file_name", "column_name"))
    counted = read.withColumn("is_mixed", (F.col("layout_count") < most) & (F.col("layout_count") + most <= F.col("timestamp_values")))
    return counted.filter("layout_count > 0").drop("timestamp_values")


def _best_layouts(columns: DataFrame) -> dict[str, dict[str, str]]:
    """Layout with most values of each timestamp-like column, by table; the first of equal ones."""
    best: dict[str, dict[str, str]] = {}
    for row in columns.filter("layout_values IS NOT NULL").collect():
        best.setdefault(row.file_name, {})[row.column_name] = max(LAYOUTS, key=lambda layout: row.layout_values[layout])
    return best


def table_statistics(tables: Tables) -> DataFrame:
    """Statistics of all columns, measured now: one row per column, so the driver can hold them."""
    measured = union_all(column_statistics(df, label) for label, df in tables.items())
    return measured.sparkSession.createDataFrame(measured.collect(), measured.schema)


def _counted_duplicates(tables: Tables, keys: DataFrame) -> DataFrame:
    """Duplicates of several tables. Rows with a key of different values differ, so tables with one need no grouping.

    Fractions are no such key: the two zeros are different texts and equal values.
    """
    fractions = (T.DoubleType, T.FloatType)
    keyed = {r.file_name for r in keys.collect() if not isinstance(tables[r.file_name].schema[r.column_name].dataType, fractions)}
    counted = [duplicate_rows(df, label) for label, df in tables.items() if label not in keyed]
    none = keys.sparkSession.createDataFrame([(label, 0) for label in tables if label in keyed], "file_name string, duplicate_rows bigint")
    return union_all([none, *counted])


def audit_tables(tables: Tables, example_limit: int = EXAMPLE_LIMIT) -> Audit:
    """Measure several tables; labels are the mapping's keys."""
    if example_limit < 1:
        raise ValueError("example_limit must be at least 1.")
    columns = table_statistics(tables)
    layouts = _best_layouts(columns)

    @cache
    def keys() -> DataFrame:
        found = candidate_keys(tables, columns)
        return columns.sparkSession.createDataFrame(found.collect(), found.schema)

    def examples() -> DataFrame:
        # Only columns with invalid values have examples.
        broken: dict[str, list[str]] = {}
        for row in columns.filter("invalid_timestamps > 0").collect():
            broken.setdefault(row.file_name, []).append(sql.name(row.column_name))
        found = [
            invalid_timestamp_examples(tables[label].select(*names), label, example_limit, layouts.get(label))
            for label, names in broken.items()
        ]
        return union_all(found) if found else empty_frame(columns.sparkSession, "file_name string, column_name string, invalid_examples string")

    return Audit(columns, {"duplicates": lambda: _counted_duplicates(tables, keys()), "keys": keys, "examples": examples})


def audit_table(df: DataFrame, label: str, example_limit: int = EXAMPLE_LIMIT) -> Audit:
    """Measure one table."""
    return audit_tables({label: df}, example_limit)


# Reports over measured frames.


def shapes(audit: Audit) -> DataFrame:
    """Rows, columns and column names per table."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "column_name")))
    return audit.columns.groupBy("file_name").agg(
        F.max("row_count").alias("row_count"),
        F.count("*").alias("column_count"),
        F.array_join(F.transform(ordered, lambda pair: pair["column_name"]), ", ").alias("column_names"),
    )


def timestamp_issues(audit: Audit) -> DataFrame:
    """One row per populated timestamp-like text column."""
    populated = audit.columns.filter(F.col("timestamp_values") > 0)
    return populated.join(audit.examples, ["file_name", "column_name"], "left").select(
        "file_name",
        "column_name",
        F.col("timestamp_values").alias("non_null_values"),
        F.col("invalid_timestamps").alias("invalid_values"),
        report_percent("invalid_timestamps", "timestamp_values").alias("invalid_percent"),
        F.coalesce("invalid_examples", F.lit("")).alias("invalid_examples"),
    )


def _table_facts(audit: Audit) -> DataFrame:
    """One row per table with everything warnings and overview need."""
    facts = audit.columns.groupBy("file_name").agg(
        F.max("row_count").alias("row_count"),
        F.count("*").alias("column_count"),
        F.count_if(F.col("missing_values") > 0).alias("columns_with_missing"),
        F.coalesce(F.sum(F.when(F.col("timestamp_values") > 0, F.col("invalid_timestamps"))), F.lit(0)).alias(
            "invalid_timestamps"
        ),
    )
    positions = audit.columns.select("file_name", "column_name", "position")
    keys = (
        audit.keys.join(positions, ["file_name", "column_name"])
        .groupBy("file_name")
        .agg(F.array_sort(F.collect_list(F.struct("position", "column_name"))).alias("pairs"))
        .select("file_name", F.transform("pairs", lambda pair: pair["column_name"]).alias("key_columns"))
    )
    number = lambda column: F.format_number(F.col(column), 0)
    # The warning texts.
    messages = [
        F.when(F.col("row_count") == 0, "The file contains no data rows."),
        F.when(
            F.col("duplicate_rows") > 0,
            F.concat(F.lit("Found "), number("duplicate_rows"), F.lit(" fully duplicated row(s).")),
        ),
        F.when(
            F.col("columns_with_missing") > 0,
            F.concat(F.lit("Found missing values in "), number("columns_with_missing"), F.lit(" column(s).")),
        ),
        F.when(
            F.col("invalid_timestamps") > 0,
            F.concat(
                F.lit("Found "),
                number("invalid_timestamps"),
                F.lit(" unparseable value(s) in timestamp-like columns."),
            ),
        ),
        F.when(
            F.col("key_columns").isNull(),
            "No single non-null, unique ID-like column was identified; verify the intended key grain.",
        ),
    ]
    return (
        facts.join(audit.duplicates, "file_name")
        .join(keys, "file_name", "left")
        .withColumn("warnings", F.array_compact(F.array(*messages)))
    )


def warnings(audit: Audit) -> DataFrame:
    """One row per warning."""
    return _table_facts(audit).select("file_name", F.explode("warnings").alias("message"))


def overview(audit: Audit) -> DataFrame:
    """One row per table."""
    return _table_facts(audit).select(
        "file_name",
        F.col("row_count").alias("rows"),
        F.col("column_count").alias("columns"),
        "duplicate_rows",
        "columns_with_missing",
        F.coalesce(F.array_join("key_columns", ", "), F.lit("None identified")).alias("likely_primary_keys"),
        F.size("warnings").cast("bigint").alias("quality_warnings"),
    )


def column_quality(audit: Audit) -> DataFrame:
    """One row per column."""
    keys = audit.keys.withColumn("is_key", F.lit(True))
    return audit.columns.join(keys, ["file_name", "column_name"], "left").select(
        "file_name",
        "column_name",
        F.col("inferred_type").alias("inferred_dtype"),
        "missing_values",
        report_percent("missing_values", "row_count").alias("missing_percent"),
        F.coalesce("is_key", F.lit(False)).alias("likely_primary_key"),
    )


def issue_register(audit: Audit, load_errors: Mapping[str, str] | None = None) -> DataFrame:
    """Warnings and load errors as (file_name, issue_type, message)."""
    found = warnings(audit).select("file_name", F.lit("quality_warning").alias("issue_type"), "message")
    if not load_errors:
        return found
    rows = [(name, "load_error", message) for name, message in sorted(load_errors.items())]
    schema = "file_name string, issue_type string, message string"
    return found.unionByName(found.sparkSession.createDataFrame(rows, schema))


def relational_issues(reports: Mapping[str, DataFrame]) -> DataFrame:
    """Every check row that did not pass, as (file_name, issue_type, message)."""
    frames = []
    for name, report in reports.items():
        if "status" not in report.columns:
            continue

        def pick(*columns: str, present: set[str] = frozenset(report.columns)) -> list[Column]:
            return [F.nullif(F.col(c), F.lit("")) for c in columns if c in present]

        file_name = F.split(F.coalesce(*pick("file_name", "child_reference"), F.lit("")), ":")[0]
        identifier = F.coalesce(*pick("rule_name", "relationship", "primary_key"), file_name)
        frames.append(
            report.filter(F.col("status") != "passed").select(
                file_name.alias("file_name"),
                F.lit(name.removesuffix("_checks")).alias("issue_type"),
                F.concat(identifier, F.lit(" returned status '"), F.col("status"), F.lit("'.")).alias("message"),
            )
        )
    return union_all(frames)


def status_counts(reports: Mapping[str, DataFrame]) -> DataFrame:
    """(report, status, checks) for every report that has a status."""
    return union_all(
        report.groupBy("status").agg(F.count("*").alias("checks")).select(F.lit(name).alias("report"), "status", "checks")
        for name, report in reports.items()
        if "status" in report.columns
    )


def audit_totals(audit: Audit, discovered: int, load_errors: int) -> DataFrame:
    """One row: files, audited files, load errors, rows over all tables."""
    return shapes(audit).agg(
        F.lit(discovered).cast("bigint").alias("discovered_file_count"),
        F.count("*").alias("audited_file_count"),
        F.lit(load_errors).cast("bigint").alias("load_error_count"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows_across_source_tables"),
    )


def empty_totals(spark: SparkSession, discovered: int, load_errors: int) -> DataFrame:
    """The same row where no file could be read."""
    columns = "discovered_file_count bigint, audited_file_count bigint, load_error_count bigint, total_rows_across_source_tables bigint"
    return spark.createDataFrame([(discovered, 0, load_errors, 0)], columns)


def flag_counts(df: DataFrame) -> DataFrame:
    """(flag, true_rows) per ``dq_*`` column; null counts as false."""
    flags = [name for name in df.columns if name.startswith("dq_")]
    if not flags:
        return empty_frame(df.sparkSession, "flag string, true_rows bigint")
    row = df.selectExpr(*[f"count_if(CAST({sql.name(f)} AS boolean)) AS {sql.name(f)}" for f in flags])
    return unpivot_row(row, [{"flag": sql.literal(f), "true_rows": sql.name(f)} for f in flags])
