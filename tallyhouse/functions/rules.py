"""Rule lists compiled into one aggregate per table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.functions import sql


def unpivot_row(row: DataFrame, records: Iterable[Mapping[str, str]]) -> DataFrame:
    """Turn a one-row frame into one row per record of SQL expressions; all records carry the same names."""
    structs = [
        "named_struct(" + ", ".join(f"{sql.literal(name)}, {value}" for name, value in record.items()) + ")"
        for record in records
    ]
    return row.selectExpr(f"inline(array({', '.join(structs)}))")


def violation_counts(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """(check_name, violation_count) for all rules of one table in a single pass.

    A rule that is null on a row does not count.
    """
    names = list(rules)
    row = df.selectExpr(*[f"count_if({rules[name]}) AS v{i}" for i, name in enumerate(names)])
    return unpivot_row(
        row,
        [{"check_name": sql.literal(name), "violation_count": f"v{i}"} for i, name in enumerate(names)],
    )


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    fields = (part.split() for part in schema.split(","))
    return spark.range(0).selectExpr(*[f"CAST(NULL AS {kind}) AS {sql.name(field)}" for field, kind in fields])
