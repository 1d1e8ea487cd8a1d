"""All key questions of a set of tables from one shuffle.

A key use is a column set of one table: a key that should be unique, or a column that should find its value in such a
key. Every use of every table becomes rows of one tagged union (space, slot, key): a key and the columns that refer to it
share a space, and each of them has a slot in it. One grouped count per (space, key) then knows how often every table
holds that key, so duplicates, nulls, orphans and distinct orphans of all rules follow from one more aggregate over
the groups. Each table is scanned once for all its uses, rows of one key combine before the shuffle, and no rule needs
a join of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import sql
from tallyhouse.functions.rules import union_all

Tables = Mapping[str, DataFrame]

FACTS = ("row_count", "null_rows", "duplicate_groups", "duplicate_rows", "surplus_rows", "orphan_rows", "orphan_keys")


@dataclass(frozen=True)
class KeyUse:
    """Columns of a table; ``within`` is the use (table, columns) whose keys they refer to, None for a key itself."""

    table: str
    columns: tuple[str, ...]
    within: tuple[str, tuple[str, ...]] | None = None

    @property
    def space(self) -> tuple[str, tuple[str, ...]]:
        return self.within or (self.table, self.columns)

    @property
    def label(self) -> str:
        own = f"{self.table}.{'+'.join(self.columns)}"
        return f"{own}>{self.within[0]}.{'+'.join(self.within[1])}" if self.within else own


def reference_use(child: str, column: str, parent: str, parent_column: str) -> KeyUse:
    """The use of a column that refers to another table's column."""
    return KeyUse(child, (column,), (parent, (parent_column,)))


def _common_type(kinds: list[T.DataType]) -> str | None:
    """Type in which keys of different tables are compared; None where they agree."""
    if len(set(kinds)) == 1:
        return None
    return "double" if all(isinstance(kind, T.NumericType) for kind in kinds) else "string"


def _key_sql(columns: tuple[str, ...], kinds: list[str | None]) -> tuple[str, str]:
    """SQL of the key as text, and of whether a part of it is null; lengths keep composite keys apart."""
    values = [f"CAST({sql.name(c) if kind is None else f'CAST({sql.name(c)} AS {kind})'} AS string)" for c, kind in zip(columns, kinds, strict=True)]
    no_value = " OR ".join(f"{sql.name(c)} IS NULL" for c in columns)
    if len(columns) == 1:
        return values[0], no_value
    parts = ", ".join(f"coalesce(concat(length({v}), ':', {v}), 'n')" for v in values)
    return f"concat({parts})", no_value


def _spaces(uses: Iterable[KeyUse]) -> dict[tuple[str, tuple[str, ...]], list[KeyUse]]:
    """Uses by space; the first one of a space is its key."""
    spaces: dict[tuple[str, tuple[str, ...]], list[KeyUse]] = {}
    for use in uses:
        slots = spaces.setdefault(use.space, [KeyUse(*use.space)])
        if use not in slots:
            slots.append(use)
    return spaces


def tagged_keys(tables: Tables, uses: Iterable[KeyUse]) -> DataFrame:
    """(space, slot, key, no_value) of all uses, one scan per table."""
    by_table: dict[str, list[str]] = {}
    for number, slots in enumerate(_spaces(uses).values()):
        width = len(slots[0].columns)
        kinds = [_common_type([tables[u.table].schema[u.columns[i]].dataType for u in slots]) for i in range(width)]
        for slot, use in enumerate(slots):
            key, no_value = _key_sql(use.columns, kinds)
            by_table.setdefault(use.table, []).append(f"named_struct('space', {number}, 'slot', {slot}, 'key', {key}, 'no_value', {no_value})")
    return union_all(tables[name].selectExpr(f"inline(array({', '.join(structs)}))") for name, structs in by_table.items())


def key_facts(tables: Tables, uses: Iterable[KeyUse]) -> DataFrame:
    """One row per use: (label, *FACTS), zeros for empty tables.

    ``duplicate_groups``, ``duplicate_rows`` and ``surplus_rows`` count the keys held by several rows, all such rows, and those
    beyond the first of each key; nulls group as equal. ``orphan_rows`` and ``orphan_keys`` count complete keys that the key
    of the space lacks.
    """
    uses = list(uses)
    spaces = _spaces(uses)
    slots = max(map(len, spaces.values()))
    counted = tagged_keys(tables, uses).groupBy("space", "key", "no_value").agg(*[F.count_if(F.col("slot") == s).alias(f"n{s}") for s in range(slots)])
    totals = []
    for s in range(slots):
        n, orphan = F.col(f"n{s}"), ~F.col("no_value") & (F.col("n0") == 0)
        totals += [
            F.sum(n).alias(f"row_count{s}"),
            F.sum(F.when(F.col("no_value"), n).otherwise(0)).alias(f"null_rows{s}"),
            F.count_if(n > 1).alias(f"duplicate_groups{s}"),
            F.sum(F.when(n > 1, n).otherwise(0)).alias(f"duplicate_rows{s}"),
            F.sum(F.greatest(n - 1, F.lit(0))).alias(f"surplus_rows{s}"),
            F.sum(F.when(orphan, n).otherwise(0)).alias(f"orphan_rows{s}"),
            F.count_if(orphan & (n > 0)).alias(f"orphan_keys{s}"),
        ]
    rows = ", ".join("named_struct('slot', {0}, {1})".format(s, ", ".join(f"'{fact}', {fact}{s}" for fact in FACTS)) for s in range(slots))
    facts = counted.groupBy("space").agg(*totals).selectExpr("space", f"inline(array({rows}))")
    labels = [(number, slot, use.label) for number, group in enumerate(spaces.values()) for slot, use in enumerate(group)]
    spark = facts.sparkSession
    asked = spark.createDataFrame(labels, "space int, slot int, label string")
    found = asked.join(facts, ["space", "slot"], "left")
    return found.select("label", *[F.coalesce(F.col(fact), F.lit(0)).alias(fact) for fact in FACTS])


def rule_rows(facts: DataFrame, rules: Mapping[str, tuple[KeyUse, str]]) -> DataFrame:
    """(rule, counted) per named rule: the SQL expression of the rule over the facts of its use."""
    rows = [(name, use.label) for name, (use, _) in rules.items()]
    asked = facts.sparkSession.createDataFrame(rows, "rule string, label string")
    counted = F.expr(" ".join(["CASE", *[f"WHEN rule = {sql.literal(name)} THEN {value}" for name, (_, value) in rules.items()], "END"]))
    return asked.join(facts, "label").select("rule", counted.cast("bigint").alias("counted"))
