"""Contract checks: each returns a report with a status per rule.

Statuses: ``passed``, ``review`` (observed, tolerated) and ``failed``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.contracts import MARKETPLACE, AllowedValues, ContractSet, Precedence
from tallyhouse.functions import sql
from tallyhouse.functions.rounding import report_percent
from tallyhouse.functions.rules import empty_frame, union_all, unpivot_row
from tallyhouse.functions.time import LAYOUTS, STANDARD, layout_counts_sql, parse_timestamp_sql
from tallyhouse.operators.key_index import FACTS, KeyUse, key_facts, reference_use

SCHEMA_REPORT = (
    "file_name string, status string, missing_columns string, unexpected_columns string, "
    "expected_column_count bigint, actual_column_count bigint"
)
KEY_REPORT = (
    "file_name string, grain string, primary_key string, row_count bigint, null_key_rows bigint, "
    "duplicate_key_rows bigint, duplicate_key_occurrences bigint, status string"
)
REFERENCE_REPORT = (
    "relationship string, child_reference string, parent_reference string, child_rows bigint, "
    "null_child_keys bigint, orphan_rows bigint, distinct_orphan_keys bigint, matched_non_null_percent double, "
    "status string"
)
RULE_REPORT = (
    "rule_name string, file_name string, rule_type string, comparable_rows bigint, violation_rows bigint, "
    "violation_percent double, details string, status string"
)

Tables = Mapping[str, DataFrame]


def _status(violated: Column, severity: str) -> Column:
    return F.when(violated, severity).otherwise("passed")


def schema_checks(spark: SparkSession, tables: Tables, contracts: ContractSet = MARKETPLACE) -> DataFrame:
    """Declared against actual columns; works on metadata alone."""
    rows = []
    for name, contract in contracts.sources.items():
        expected = set(contract.columns)
        if name not in tables:
            rows.append((contract.file_name, "failed", "ALL — source file missing", "", len(expected), 0))
            continue
        actual = set(tables[name].columns)
        missing, unexpected = sorted(expected - actual), sorted(actual - expected)
        status = "failed" if missing else "review" if unexpected else "passed"
        rows.append(
            (contract.file_name, status, " | ".join(missing), " | ".join(unexpected), len(expected), len(actual))
        )
    return spark.createDataFrame(rows, SCHEMA_REPORT)


def key_statistics(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """One row: rows, rows with a null in the key, rows in duplicate groups, rows beyond the first of a group.

    Nulls group as equal. Counting per key combines on the map side, so a key shared by very many rows reaches
    the shuffle as one row per task.
    """
    parts = [f"key{i}" for i in range(len(key))]
    groups = df.groupBy(*[F.col(c).alias(p) for c, p in zip(key, parts, strict=True)]).agg(F.count("*").alias("n"))
    any_null = F.lit(False)
    for part in parts:
        any_null = any_null | F.col(part).isNull()
    n = F.col("n")
    return groups.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(any_null, n)), F.lit(0)).alias("null_key_rows"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("duplicate_key_rows"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicate_key_occurrences"),
    )


def _keyed(tables: Tables, contracts: ContractSet) -> list:
    """Contracts of the tables that have a key and all of its columns."""
    return [
        table
        for name, table in contracts.sources.items()
        if table.key and name in tables and set(table.key) <= set(tables[name].columns)
    ]


def _is_present(tables: Tables, rule) -> bool:
    """Whether both ends of a reference are there."""
    child, parent = tables.get(rule.child), tables.get(rule.parent)
    return child is not None and parent is not None and rule.column in child.columns and rule.column in parent.columns


def shared_key_facts(tables: Tables, contracts: ContractSet = MARKETPLACE) -> DataFrame | None:
    """Facts of all declared keys and references from one shuffle, computed once: a row per use.

    None where there is nothing to share, or where the ends of a reference differ in type: their keys would be compared in
    another type than the key alone.
    """
    rules = [rule for rule in contracts.references if _is_present(tables, rule)]
    if any(tables[r.child].schema[r.column].dataType != tables[r.parent].schema[r.column].dataType for r in rules):
        return None
    uses = [KeyUse(table.name, table.key) for table in _keyed(tables, contracts)]
    if not uses or not rules:
        return None
    facts = key_facts(tables, [*uses, *(reference_use(r.child, r.column, r.parent, r.column) for r in rules)])
    return facts.sparkSession.createDataFrame(facts.collect(), facts.schema)


def key_checks(
    spark: SparkSession, tables: Tables, contracts: ContractSet = MARKETPLACE, facts: DataFrame | None = None
) -> DataFrame:
    """Declared keys, all from one shuffle; tables without a key, or without one of its columns, are skipped."""
    keyed = _keyed(tables, contracts)
    if not keyed:
        return empty_frame(spark, KEY_REPORT)
    uses = [KeyUse(table.name, table.key) for table in keyed]
    rows = [(use.label, table.file_name, table.grain, " + ".join(table.key)) for use, table in zip(uses, keyed, strict=True)]
    described = spark.createDataFrame(rows, "label string, file_name string, grain string, primary_key string")
    violated = (F.col("null_rows") > 0) | (F.col("duplicate_rows") > 0)
    return described.join(key_facts(tables, uses) if facts is None else facts, "label").select(
        "file_name",
        "grain",
        "primary_key",
        "row_count",
        F.col("null_rows").alias("null_key_rows"),
        F.col("duplicate_rows").alias("duplicate_key_rows"),
        F.col("surplus_rows").alias("duplicate_key_occurrences"),
        _status(violated, "failed").alias("status"),
    )


def reference_checks(
    spark: SparkSession, tables: Tables, contracts: ContractSet = MARKETPLACE, facts: DataFrame | None = None
) -> DataFrame:
    """All foreign keys from one shuffle; an absent table or column is a failed row of zeros."""
    described, uses = [], []
    for rule in contracts.references:
        present = _is_present(tables, rule)
        use = reference_use(rule.child, rule.column, rule.parent, rule.column)
        if present:
            uses.append(use)
        described.append(
            (
                rule.name,
                use.label if present else None,
                f"{contracts.file_name(rule.child)}:{rule.column}",
                f"{contracts.file_name(rule.parent)}:{rule.column}",
                not rule.tolerant,
                "review" if rule.tolerant else "failed",
            )
        )
    if not described:
        return empty_frame(spark, REFERENCE_REPORT)
    rules = spark.createDataFrame(
        described,
        "relationship string, label string, child_reference string, parent_reference string, filled boolean, severity string",
    )
    if uses:
        found = rules.join(key_facts(tables, uses) if facts is None else facts, "label", "left")
    else:
        found = rules.withColumns({fact: F.lit(None).cast("bigint") for fact in FACTS})
    counts = {"row_count": "child_rows", "null_rows": "null_child_keys", "orphan_rows": "orphan_rows", "orphan_keys": "distinct_orphan_keys"}
    counted = found.select(
        "relationship", "label", "child_reference", "parent_reference", "filled", "severity",
        *[F.coalesce(F.col(fact), F.lit(0)).alias(name) for fact, name in counts.items()],
    )
    violated = (F.col("orphan_rows") > 0) | (F.col("filled") & (F.col("null_child_keys") > 0))
    absent = F.col("label").isNull()
    matched = report_percent("(child_rows - null_child_keys - orphan_rows)", "(child_rows - null_child_keys)", empty=100.0)
    return counted.select(
        "relationship", "child_reference", "parent_reference", *counts.values(),
        F.when(absent, F.lit(0.0)).otherwise(matched).alias("matched_non_null_percent"),
        F.when(absent, "failed").when(violated, F.col("severity")).otherwise("passed").alias("status"),
    )


def disallowed_values(df: DataFrame, rule: AllowedValues) -> DataFrame:
    """Every value outside the allowed set with its number of rows."""
    value = F.col(rule.column)
    return (
        df.filter(value.isNotNull() & ~value.isin(*rule.values))
        .groupBy(value.cast("string").alias("bad_value"))
        .agg(F.count("*").alias("violation_rows"))
    )


def allowed_value_check(df: DataFrame, rule: AllowedValues, contracts: ContractSet = MARKETPLACE) -> DataFrame:
    """One report row for an allowed-value rule; the percentage is over all rows, nulls included."""
    counts = df.groupBy(F.col(rule.column).alias("checked")).agg(F.count("*").alias("n"))
    checked, n = F.col("checked"), F.col("n")
    bad = checked.isNotNull() & ~checked.isin(*rule.values)
    total = counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(checked.isNotNull(), n)), F.lit(0)).alias("comparable_rows"),
        F.coalesce(F.sum(F.when(bad, n)), F.lit(0)).alias("violation_rows"),
        F.count_if(bad).alias("bad_values"),
    )
    # The values themselves are rows of disallowed_values: a report cell must not grow with the data.
    details = F.format_string("%d distinct values, listed by disallowed_values", F.col("bad_values"))
    return total.select(
        F.lit(rule.name).alias("rule_name"),
        F.lit(contracts.file_name(rule.table)).alias("file_name"),
        F.lit("allowed_values").alias("rule_type"),
        "comparable_rows",
        "violation_rows",
        report_percent("violation_rows", "`rows`").alias("violation_percent"),
        details.alias("details"),
        _status(F.col("violation_rows") > 0, "failed").alias("status"),
    )


def _timestamp_sql(df: DataFrame, column: str, layout: str) -> str:
    value = sql.name(column)
    text = isinstance(df.schema[column].dataType, T.StringType)
    return f"({parse_timestamp_sql(value, layout)})" if text else f"CAST({value} AS timestamp_ntz)"


def _layouts(df: DataFrame, columns: Iterable[str]) -> dict[str, str]:
    """Layouts of text columns by vote; of two that read as many values the first one holds here."""
    texts = [column for column in columns if isinstance(df.schema[column].dataType, T.StringType)]
    if not texts:
        return {}
    row = df.selectExpr(*[f"{layout_counts_sql(sql.name(column))} AS c{i}" for i, column in enumerate(texts)]).first()
    return {column: max(LAYOUTS, key=lambda layout: counts[layout]) for column, counts in zip(texts, row, strict=True)}


def time_order_check(df: DataFrame, rules: list[Precedence], contracts: ContractSet = MARKETPLACE) -> DataFrame:
    """Report rows for all timestamp rules of one table, from one aggregate; a violation is for review only."""
    needed = dict.fromkeys(column for rule in rules for column in (rule.first.column, rule.then.column))
    layouts = _layouts(df, needed)
    parsed = df.selectExpr(*[f"{_timestamp_sql(df, column, layouts.get(column, STANDARD))} AS {sql.name(column)}" for column in needed])
    counters = []
    for i, rule in enumerate(rules):
        earlier, later = sql.name(rule.first.column), sql.name(rule.then.column)
        counters.append(f"count_if({earlier} IS NOT NULL AND {later} IS NOT NULL) AS comparable{i}")
        counters.append(f"count_if({earlier} > {later}) AS violation{i}")
    records = [
        {
            "rule_name": sql.literal(rule.name),
            "file_name": sql.literal(contracts.file_name(rule.table)),
            "rule_type": "'timestamp_order'",
            "comparable_rows": f"comparable{i}",
            "violation_rows": f"violation{i}",
            "violation_percent": sql.percent(f"violation{i}", f"comparable{i}"),
            "details": sql.literal(f"{rule.first.column} <= {rule.then.column}"),
            "status": f"if(violation{i} > 0, 'review', 'passed')",
        }
        for i, rule in enumerate(rules)
    ]
    return unpivot_row(parsed.selectExpr(*counters), records)


def business_rule_checks(spark: SparkSession, tables: Tables, contracts: ContractSet = MARKETPLACE) -> DataFrame:
    """Allowed values and timestamp order; rules whose table or columns are absent are skipped."""
    reports = [
        allowed_value_check(tables[rule.table], rule, contracts)
        for rule in contracts.allowed_values
        if rule.table in tables and rule.column in tables[rule.table].columns
    ]
    for table in dict.fromkeys(rule.table for rule in contracts.precedences):
        if table in tables:
            columns = set(tables[table].columns)
            rules = [r for r in contracts.precedences if r.table == table and {r.first.column, r.then.column} <= columns]
            if rules:
                reports.append(time_order_check(tables[table], rules, contracts))
    return union_all(reports) if reports else empty_frame(spark, RULE_REPORT)


def relational_quality_reports(
    spark: SparkSession, tables: Tables, contracts: ContractSet = MARKETPLACE
) -> dict[str, DataFrame]:
    """The four reports over one set of tables."""
    facts = shared_key_facts(tables, contracts)
    return {
        "schema_checks": schema_checks(spark, tables, contracts),
        "key_checks": key_checks(spark, tables, contracts, facts),
        "relationship_checks": reference_checks(spark, tables, contracts, facts),
        "business_rule_checks": business_rule_checks(spark, tables, contracts),
    }
