from __future__ import annotations

import random
from collections import Counter

from tallyhouse.operators.key_index import KeyUse, key_facts, reference_use, rule_rows, tagged_keys


def brute_force(tables, use):
    keys = [tuple(row[c] for c in use.columns) for row in tables[use.table].collect()]
    space, columns = use.space
    known = {tuple(row[c] for c in columns) for row in tables[space].collect()}
    groups = Counter(keys)
    orphans = [key for key in keys if None not in key and key not in known]
    return (
        len(keys),
        sum(None in key for key in keys),
        sum(n > 1 for n in groups.values()),
        sum(n for n in groups.values() if n > 1),
        sum(n - 1 for n in groups.values()),
        len(orphans),
        len(set(orphans)),
    )


def test_facts_equal_brute_force(spark):
    rng = random.Random(5)
    value = lambda n: None if rng.random() < 0.1 else str(rng.randrange(n))
    tables = {
        "parents": spark.createDataFrame([(value(30), value(3)) for _ in range(60)], "id string, part string"),
        "children": spark.createDataFrame([(value(60), value(9)) for _ in range(200)], "parent string, other string"),
        "none": spark.createDataFrame([], "parent string"),
    }
    uses = [
        KeyUse("parents", ("id",)),
        KeyUse("parents", ("id", "part")),
        reference_use("children", "parent", "parents", "id"),
        reference_use("children", "other", "parents", "part"),
        reference_use("none", "parent", "parents", "id"),
        reference_use("children", "parent", "none", "parent"),
    ]
    found = {row.label: tuple(row)[1:] for row in key_facts(tables, uses).collect()}
    assert all(found[use.label] == brute_force(tables, use) for use in uses)
    counted = rule_rows(key_facts(tables, uses), {"a": (uses[2], "orphan_rows + null_rows"), "b": (uses[0], "surplus_rows")})
    lost, surplus = brute_force(tables, uses[2]), brute_force(tables, uses[0])
    assert {row.rule: row.counted for row in counted.collect()} == {"a": lost[5] + lost[1], "b": surplus[4]}


def test_parts_of_a_composite_key_stay_apart(spark):
    table = spark.createDataFrame([("1:a", "b"), ("1", "a:b"), ("n", None), (None, "n")], "x string, y string")
    assert key_facts({"t": table}, [KeyUse("t", ("x", "y"))]).first().duplicate_groups == 0


def test_keys_of_other_number_types_meet(spark):
    tables = {"p": spark.createDataFrame([(1.0,), (2.0,)], "k double"), "c": spark.createDataFrame([(1,), (3,)], "k int")}
    assert {r.label: r.orphan_rows for r in key_facts(tables, [reference_use("c", "k", "p", "k")]).collect()}["c.k>p.k"] == 1


def test_one_exchange_over_the_keys_and_one_scan_per_table(spark, tmp_path):
    for name in ("a", "b", "c"):
        spark.range(50).selectExpr("id AS k", "id % 5 AS other").write.parquet(f"{tmp_path}/{name}")
    tables = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("a", "b", "c")}
    uses = [KeyUse("a", ("k",)), KeyUse("b", ("k", "other")), reference_use("b", "k", "a", "k"), reference_use("c", "other", "a", "k")]
    plan = tagged_keys(tables, uses).groupBy("space", "key", "no_value").count()._jdf.queryExecution().executedPlan().toString()
    whole = key_facts(tables, uses)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == whole.count("FileScan parquet") == 3
    assert whole.count("Exchange hashpartitioning(space#") == 2  # the keys, and the few totals per space
    assert "SortMergeJoin" not in whole
