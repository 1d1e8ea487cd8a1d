from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows

from tallyhouse.contracts import MARKETPLACE, ModelTable, declared_row_rules, domain_rules
from tallyhouse.operators import domains as D

EXAMPLE = ModelTable("example", "example", {"id": "integer", "event_at": "timestamp"}, ())
REVIEWS = "review_id string, order_id string, review_score int, review_creation_date timestamp_ntz, " \
    "review_answer_timestamp timestamp_ntz"


def test_types_are_validated_and_converted(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("2.0", "2024-01-02"), (None, None)], "id string, event_at string")
    prepared = D.prepare_processed_table(df.select("event_at", "id"), EXAMPLE)
    assert prepared.dtypes == [("id", "int"), ("event_at", "timestamp_ntz")]
    assert rows(prepared, "id") == [1, 2, None]


def test_contract_drift_raises(spark):
    df = spark.createDataFrame([(1, 2)], "id int, unexpected int")
    with pytest.raises(D.LoadContractError, match="missing: event_at; not expected: unexpected"):
        D.prepare_processed_table(df, EXAMPLE)


def test_bad_values_raise_with_counts(spark):
    bad_time = spark.createDataFrame([("1", "soon")], "id string, event_at string")
    with pytest.raises(D.LoadContractError, match="event_at holds 1 unreadable"):
        D.prepare_processed_table(bad_time, EXAMPLE)
    bad_number = spark.createDataFrame([("1.5", None), ("x", None)], "id string, event_at string")
    with pytest.raises(D.LoadContractError, match="1 value.s. are no number, 1 have a fraction"):
        D.prepare_processed_table(bad_number, EXAMPLE)


def test_score_outside_its_domain_fails(spark):
    now = dt.datetime(2024, 1, 1)
    reviews = spark.createDataFrame([("r1", "o1", 6, now, now), ("r2", "o2", None, now, now)], REVIEWS)
    found = {r.check_name: r for r in D.validate_domains({"order_reviews": reviews}).collect()}
    score = found["order_reviews.review_score.between_1_and_5"]
    assert (score.violation_count, score.status, score.table_name) == (2, "failed", "marketplace.order_reviews")
    declared = D.row_rule_report({"order_reviews": reviews}, declared_row_rules())
    assert rows(declared, "violation_count") == [1]


def test_absent_column_of_a_present_table_raises(spark):
    with pytest.raises(Exception, match="review_score"):
        D.validate_domains({"order_reviews": spark.createDataFrame([("r",)], "review_id string")}).collect()


def test_rule_counts():
    assert len(domain_rules()) == 77
    assert sum(len(table.mandatory) for table in MARKETPLACE.model.values()) == 53
    assert len(MARKETPLACE.model) == 10 and len(MARKETPLACE.sources) == 9


def test_reconciliation_names_the_short_table(spark):
    one, two = spark.range(1), spark.range(2)
    report = D.reconcile_counts({"a": one, "b": two}, {"a": one, "b": one})
    assert {r.table_name: r.status for r in report.collect()} == {"marketplace.a": "passed", "marketplace.b": "failed"}
    with pytest.raises(D.LoadContractError, match="marketplace.b"):
        D.raise_on_failed(report, "Row-count verification failed", "table_name")
