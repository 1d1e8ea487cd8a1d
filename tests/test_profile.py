from __future__ import annotations

import pytest
from conftest import rows

from tallyhouse.operators import profile as P


def test_only_unique_non_null_ids_are_candidate_keys(spark):
    df = spark.createDataFrame(
        [("a", "x", "one", 1), ("b", "x", "two", 2), ("c", "y", "three", None)],
        "order_id string, customer_id string, label string, other_ID int",
    )
    assert rows(P.audit_table(df, "t").keys, "column_name") == ["order_id"]
    assert rows(P.audit_table(df.limit(0), "t").keys, "column_name") == []


def test_sketches_only_choose_what_is_counted(spark):
    df = spark.range(20_000).selectExpr("id", "id % 19000 AS nearly_id", "id % 100 AS few_id", "nullif(id, 5) AS gap_id", "id AS other")
    statistics = P.table_statistics({"t": df, "none": df.limit(0)})
    assert P.possible_keys(statistics) == {"t": ["id", "nearly_id"]}
    assert rows(P.candidate_keys({"t": df}, statistics), "column_name") == ["id"]
    estimates = {r.column_name: r.distinct_estimate for r in statistics.filter("file_name = 't'").collect()}
    assert abs(estimates["id"] - 20_000) < 1_500 and estimates["few_id"] == 100 and estimates["other"] is None


def test_blank_timestamps_are_missing_and_bad_ones_counted(spark):
    df = spark.createDataFrame(
        [("2018-01-01 10:00:00",), ("not-a-date",), ("",), (None,)], "order_purchase_timestamp string"
    )
    (row,) = P.timestamp_issues(P.audit_table(df, "t")).collect()
    assert (row.non_null_values, row.invalid_values, row.invalid_examples) == (2, 1, "not-a-date")
    assert row.invalid_percent == 50.0


def test_timestamp_columns_go_by_name_and_need_values(spark):
    df = spark.createDataFrame([("x", None, "y")], "updated_by string, empty_date string, name string")
    found = P.timestamp_issues(P.audit_table(df, "t"))
    assert rows(found, "column_name") == ["updated_by"]
    with pytest.raises(ValueError, match="at least 1"):
        P.invalid_timestamp_examples(df, "t", 0)


def test_examples_are_distinct_sorted_and_limited(spark):
    df = spark.createDataFrame([(v,) for v in "gfedcbaab"], "seen_at string")
    assert rows(P.invalid_timestamp_examples(df, "t", 3), "invalid_examples") == ["a | b | c"]


def test_duplicates_and_gaps(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (None,)], "value double")
    audit = P.audit_table(df, "sample.csv")
    assert rows(audit.duplicates, "duplicate_rows") == [1]
    assert rows(audit.columns, "missing_values") == [1]
    assert rows(P.shapes(audit), "row_count") == [3]
    with pytest.raises(ValueError, match="non-empty"):
        P.audit_table(df, " ")


def test_duplicate_digest_keeps_shifted_texts_and_nulls_apart(spark):
    data = [("ab", "c"), ("a", "bc"), (None, "abc"), ("abc", None), ("n", None), (None, "n"), ("", "x"), (None, "x")]
    df = spark.createDataFrame(data + [("ab", "c"), (None, "abc"), (None, "abc")], "a string, b string")
    assert rows(P.duplicate_rows(df, "t"), "duplicate_rows") == [3]
    wide = spark.createDataFrame([(0.0, "x", ["a, b"]), (-0.0, "x", ["a, b"]), (0.0, "x", ["a", "b"])],
                                 "v double, t string, l array<string>")
    assert rows(P.duplicate_rows(wide, "t"), "duplicate_rows") == [1]


def test_inferred_types(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "True", "x", None, None), ("-2", "3", "false", "1", None, "7")],
        "i string, d string, b string, s string, nothing string, gaps string",
    )
    assert rows(P.column_statistics(df, "t").orderBy("position"), "inferred_type") == [
        "bigint", "double", "boolean", "string", "double", "bigint",
    ]


def test_column_quality_and_warnings(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "order_id string, value double")
    audit = P.audit_table(df, "orders.csv")
    found = {r.column_name: r for r in P.column_quality(audit).collect()}
    assert (found["value"].missing_values, found["value"].missing_percent) == (1, 50.0)
    assert found["order_id"].likely_primary_key and not found["value"].likely_primary_key
    assert rows(P.warnings(audit), "message") == ["Found missing values in 1 column(s)."]
    empty = P.audit_table(df.limit(0), "none.csv")
    assert len(rows(P.warnings(empty), "message")) == 2
    assert rows(P.overview(empty), "likely_primary_keys") == ["None identified"]
    register = P.issue_register(audit, {"z.csv": "broken", "b.csv": "broken"})
    assert [r.issue_type for r in register.collect()] == ["quality_warning", "load_error", "load_error"]


def test_flag_counts_ignore_null(spark):
    df = spark.createDataFrame([(True, 1), (None, 2), (False, 3)], "dq_x boolean, y int")
    assert [tuple(r) for r in P.flag_counts(df).collect()] == [("dq_x", 1)]


def test_integers_are_what_a_bigint_holds(spark):
    df = spark.createDataFrame([("9223372036854775807", "9223372036854775808")], "fits string, beyond string")
    assert rows(P.column_statistics(df, "t").orderBy("position"), "inferred_type") == ["bigint", "double"]


def test_each_text_pattern_is_compiled_once_for_all_columns(spark):
    df = spark.range(3).selectExpr(*[f"cast(id AS string) AS c{i}" for i in range(6)], *[f"cast(id AS string) AS at{i}_time" for i in range(4)])
    plan = P.column_statistics(df, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") <= 5
    assert [r.inferred_type for r in P.column_statistics(df, "t").collect()] == ["bigint"] * 10


def test_types_of_odd_texts(spark):
    kinds = {
        "bigint": ["5", "+5", " 5\t", "-9223372036854775808"],
        "double": ["5.", ".5", "1e5", "123e-5", "9223372036854775808", "5.0 "],
        "boolean": ["True", "FALSE", "false"],
        "string": ["", "1234-5", "5d", "1e", "+", "TRUE ", "\u0661", "1995-01-02"],
    }
    texts = [text for found in kinds.values() for text in found]
    df = spark.createDataFrame([tuple(texts)], ", ".join(f"c{i} string" for i in range(len(texts))))
    found = {r.column_name: r.inferred_type for r in P.column_statistics(df, "t").collect()}
    assert [found[f"c{i}"] for i in range(len(texts))] == [kind for kind, some in kinds.items() for _ in some]


def test_an_empty_table_has_statistics_of_all_columns(spark):
    df = spark.createDataFrame([], "order_id string, made_at string, n int")
    found = [(r.position, r.column_name, r.inferred_type, r.row_count, r.missing_values, r.timestamp_values, r.distinct_estimate) for r in P.column_statistics(df, "t").orderBy("position").collect()]
    assert found == [(1, "order_id", "double", 0, 0, None, 0), (2, "made_at", "double", 0, 0, 0, None), (3, "n", "int", 0, 0, None, None)]


def test_a_table_with_a_key_is_not_grouped_for_duplicates(spark, monkeypatch):
    grouped = []
    count = P.duplicate_rows
    monkeypatch.setattr(P, "duplicate_rows", lambda df, label: grouped.append(label) or count(df, label))
    keyed = spark.createDataFrame([("a", 1), ("b", 1)], "order_id string, n int")
    twice = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "order_id string, n int")
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "value_id double")
    audit = P.audit_tables({"keyed": keyed, "twice": twice, "zeros": zeros})
    assert not grouped
    assert {r.file_name: r.duplicate_rows for r in audit.duplicates.collect()} == {"keyed": 0, "twice": 1, "zeros": 1}
    assert grouped == ["twice", "zeros"]


def test_only_columns_with_invalid_values_are_searched_for_examples(spark, monkeypatch):
    searched = []
    search = P.invalid_timestamp_examples
    monkeypatch.setattr(P, "invalid_timestamp_examples", lambda df, *rest: searched.append(df.columns) or search(df, *rest))
    df = spark.createDataFrame([("2018-01-01", "soon", "x")], "made_at string, seen_at string, name string")
    assert rows(P.audit_table(df, "t").examples, "column_name") == ["seen_at"]
    assert searched == [["seen_at"]]
