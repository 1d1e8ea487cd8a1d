"""Validation of the processed tables before they are published."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.contracts import (
    INTEGER,
    MARKETPLACE,
    SPARK_TYPES,
    TIMESTAMP,
    ContractSet,
    ModelTable,
    Reference,
    RowRule,
    declared_row_rules,
    domain_rules,
)
from tallyhouse.functions import sql
from tallyhouse.functions.rules import union_all, unpivot_row, violation_counts
from tallyhouse.functions.time import parse_timestamp_sql
from tallyhouse.operators.key_index import KeyUse, key_facts, reference_use, rule_rows

SCHEMA = "marketplace"

Tables = Mapping[str, DataFrame]


class LoadContractError(ValueError):
    """A processed table differs from what the published model accepts."""


def check_columns(df: DataFrame, table: ModelTable, label: str) -> None:
    """Raise for missing as well as unexpected columns."""
    missing = sorted(set(table.columns) - set(df.columns))
    unexpected = sorted(set(df.columns) - set(table.columns))
    details = []
    if missing:
        details.append(f"missing: {', '.join(missing)}")
    if unexpected:
        details.append(f"not expected: {', '.join(unexpected)}")
    if details:
        raise LoadContractError(f"{label} differs from its published columns ({'; '.join(details)}).")


def column_differences(spark: SparkSession, tables: Tables, contracts: ContractSet = MARKETPLACE) -> DataFrame:
    """Missing and unexpected columns per published table; works on metadata alone."""
    rows = []
    for table in contracts.model.values():
        actual = set(tables[table.name].columns) if table.name in tables else set()
        missing, unexpected = sorted(set(table.columns) - actual), sorted(actual - set(table.columns))
        status = "failed" if missing or unexpected else "passed"
        rows.append((f"{SCHEMA}.{table.name}", " | ".join(missing), " | ".join(unexpected), status))
    schema = "table_name string, missing_columns string, unexpected_columns string, status string"
    return spark.createDataFrame(rows, schema)


def rules_like(pattern: str, contracts: ContractSet = MARKETPLACE) -> list[RowRule]:
    """Domain rules whose check name starts and ends as given by ``start%end`` (or ends with the pattern)."""
    start, _, end = pattern.rpartition("%")
    return [r for r in domain_rules(contracts) if r.check_name.startswith(start) and r.check_name.endswith(end)]


def _timestamp_sql(df: DataFrame, column: str) -> str:
    value = sql.name(column)
    text = isinstance(df.schema[column].dataType, T.StringType)
    return f"({parse_timestamp_sql(value)})" if text else f"CAST({value} AS timestamp_ntz)"


def type_violations(df: DataFrame, table: ModelTable) -> DataFrame:
    """(column_name, kind, invalid_values, non_integral_values) for all typed columns in one pass."""
    counters, records = [], []
    for i, column in enumerate(table.of_kind(TIMESTAMP, INTEGER)):
        kind, value = table.columns[column], sql.name(column)
        if kind == TIMESTAMP:
            typed, broken = _timestamp_sql(df, column), "false"
        else:
            typed = f"try_cast({value} AS double)"
            broken = f"{typed} % 1 <> 0"
        counters += [
            f"count_if({value} IS NOT NULL AND {typed} IS NULL) AS i{i}",
            f"count_if({broken}) AS b{i}",
        ]
        records.append(
            {
                "column_name": sql.literal(column),
                "kind": sql.literal(kind),
                "invalid_values": f"i{i}",
                "non_integral_values": f"b{i}",
            }
        )
    return unpivot_row(df.selectExpr(*counters), records)


def typed_table(df: DataFrame, table: ModelTable) -> DataFrame:
    """Columns in contract order with the published types."""
    columns = []
    for column, kind in table.columns.items():
        value = sql.name(column)
        if kind == TIMESTAMP:
            typed = _timestamp_sql(df, column)
        elif kind == INTEGER:
            typed = f"CAST(CAST({value} AS double) AS int)"
        else:
            typed = f"CAST({value} AS {SPARK_TYPES[kind]})"
        columns.append(f"{typed} AS {value}")
    return df.selectExpr(*columns)


def prepare_processed_table(df: DataFrame, table: ModelTable, label: str | None = None) -> DataFrame:
    """Check columns and types of one processed table and return it typed and in contract order."""
    label = label or f"{table.source}.csv"
    check_columns(df, table, label)
    if table.of_kind(TIMESTAMP, INTEGER):
        for row in type_violations(df, table).filter("invalid_values > 0 OR non_integral_values > 0").collect():
            if row.kind == TIMESTAMP:
                raise LoadContractError(
                    f"{label}: {row.column_name} holds {row.invalid_values} unreadable timestamp(s)."
                )
            raise LoadContractError(
                f"{label}: {row.column_name} is no integer column: {row.invalid_values} value(s) are no number, "
                f"{row.non_integral_values} have a fraction."
            )
    return typed_table(df, table)


def _report(counts: DataFrame, table: str) -> DataFrame:
    return counts.selectExpr(
        "check_name",
        f"'{SCHEMA}.{table}' AS table_name",
        "violation_count",
        "if(violation_count = 0, 'passed', 'failed') AS status",
    )


def row_rule_report(tables: Tables, rules: Iterable[RowRule]) -> DataFrame:
    """Row rules of all present tables, one aggregate per table.

    An absent table is skipped; a rule on an absent column of a present table fails in analysis.
    """
    by_table: dict[str, dict[str, str]] = {}
    for rule in rules:
        if rule.table in tables:
            by_table.setdefault(rule.table, {})[rule.check_name] = rule.violation
    return union_all(_report(violation_counts(tables[name], checks), name) for name, checks in by_table.items())


def validate_domains(tables: Tables, contracts: ContractSet = MARKETPLACE) -> DataFrame:
    """Mandatory columns, lengths, allowed values and ranges of all present tables."""
    return row_rule_report(tables, domain_rules(contracts))


def _uniqueness_rules(tables: Tables, contracts: ContractSet) -> dict[str, tuple[KeyUse, str]]:
    """Rows beyond the first of each key, plus rows with a null in a key."""
    rules = {}
    for table in contracts.model.values():
        columns = table.key or table.unique
        if table.name in tables and columns:
            name = f"{table.name}.{'_'.join(columns) if table.key else 'observation'}.unique"
            rules[name] = (KeyUse(table.name, columns), "surplus_rows + null_rows" if table.key else "surplus_rows")
    return rules


def _reference_rules(tables: Tables, references: Iterable[Reference]) -> dict[str, tuple[KeyUse, str]]:
    """Child rows whose non-null key has no parent."""
    return {
        rule.name: (reference_use(rule.child, rule.column, rule.parent, rule.column), "orphan_rows")
        for rule in references
        if rule.child in tables and rule.parent in tables
    }


def _key_rule_report(
    tables: Tables, rules: Mapping[str, tuple[KeyUse, str]], facts: DataFrame | None = None
) -> DataFrame:
    """Report of key rules, all from one shuffle of the keys, or from the facts of it."""
    if facts is None:
        facts = key_facts(tables, [use for use, _ in rules.values()])
    counted = rule_rows(facts, rules)
    table = "CASE " + " ".join(f"WHEN rule = {sql.literal(name)} THEN {sql.literal(use.table)}" for name, (use, _) in rules.items()) + " END"
    return counted.selectExpr(
        "rule AS check_name",
        f"concat('{SCHEMA}.', {table}) AS table_name",
        "counted AS violation_count",
        "if(counted = 0, 'passed', 'failed') AS status",
    )


def uniqueness_report(tables: Tables, contracts: ContractSet = MARKETPLACE) -> DataFrame:
    """Declared keys and unique column sets: rows in duplicate groups, plus rows with a null in a key."""
    return _key_rule_report(tables, _uniqueness_rules(tables, contracts))


def reference_report(tables: Tables, references: Iterable[Reference]) -> DataFrame:
    """Declared foreign keys: child rows whose non-null key has no parent."""
    return _key_rule_report(tables, _reference_rules(tables, references))


def _declared_keys(tables: Tables, contracts: ContractSet) -> dict[str, tuple[KeyUse, str]]:
    return _uniqueness_rules(tables, contracts) | _reference_rules(tables, contracts.model_references)


def shared_key_facts(tables: Tables, contracts: ContractSet, others: Iterable[KeyUse]) -> DataFrame | None:
    """Facts of all declared keys and references and of other uses from one shuffle, computed once: a row per use.

    None where uses of one key differ in type: together they would be compared in another type than alone.
    """
    uses = list(dict.fromkeys([*(use for use, _ in _declared_keys(tables, contracts).values()), *others]))
    for use in uses:
        parent, columns = use.space
        kinds = lambda table, names: [tables[table].schema[c].dataType for c in names]
        if kinds(use.table, use.columns) != kinds(parent, columns):
            return None
    facts = key_facts(tables, uses)
    return facts.sparkSession.createDataFrame(facts.collect(), facts.schema)


def declared_constraints(
    tables: Tables, contracts: ContractSet = MARKETPLACE, facts: DataFrame | None = None
) -> DataFrame:
    """Everything the published model declares: uniqueness, foreign keys and row constraints."""
    return _key_rule_report(tables, _declared_keys(tables, contracts), facts).unionByName(row_rule_report(tables, declared_row_rules()))


def processed_summary(tables: Tables, contracts: ContractSet = MARKETPLACE) -> DataFrame:
    """Rows and columns per processed table, and whether all its domain rules hold."""
    counts = union_all(
        tables[table.name].agg(F.count("*").alias("row_count")).select(
            F.lit(f"{table.source}.csv").alias("file_name"),
            F.lit(f"{SCHEMA}.{table.name}").alias("table_name"),
            "row_count",
            F.lit(len(tables[table.name].columns)).cast("bigint").alias("column_count"),
        )
        for table in contracts.model.values()
        if table.name in tables
    )
    broken = validate_domains(tables, contracts).where("status = 'failed'").select("table_name").distinct()
    return counts.join(broken.withColumn("status", F.lit("failed")), "table_name", "left").select(
        "file_name", "table_name", "row_count", "column_count", F.coalesce("status", F.lit("passed")).alias("status")
    )


def raise_on_failed(report: DataFrame, what: str, name_column: str = "check_name") -> None:
    """Gate: raise with the names of the failed rows."""
    failed = [row[0] for row in report.filter(F.col("status") == "failed").select(name_column).collect()]
    if failed:
        raise LoadContractError(f"{what}: {', '.join(failed)}")


def validate_processed_tables(tables: Tables, contracts: ContractSet = MARKETPLACE) -> DataFrame:
    """Summary of a processed set whose columns, types and domains hold; raises otherwise."""
    prepared = {
        table.name: prepare_processed_table(tables[table.name], table) for table in contracts.model.values()
    }
    raise_on_failed(validate_domains(prepared, contracts), "Processed data violates the declared domains")
    return processed_summary(prepared, contracts)


def reconcile_counts(prepared: Tables, published: Tables) -> DataFrame:
    """Prepared against published rows per table."""

    def counts(tables: Tables, name: str) -> DataFrame:
        return union_all(
            df.agg(F.count("*").alias(name)).withColumn("table_name", F.lit(f"{SCHEMA}.{table}"))
            for table, df in tables.items()
        )

    joined = counts(prepared, "prepared_rows").join(counts(published, "loaded_rows"), "table_name", "left")
    same = F.col("prepared_rows").eqNullSafe(F.col("loaded_rows"))
    return joined.select(
        "table_name", "prepared_rows", "loaded_rows", F.when(same, "passed").otherwise("failed").alias("status")
    )
