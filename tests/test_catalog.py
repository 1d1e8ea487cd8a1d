"""Registered queries against their DuckDB statements on the smallest test tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
from tallyhouse.plans.catalog import catalog_oracle, catalog_queries
from tallyhouse.sources.testbed import TABLE_SCHEMAS

FOLDER = "/root/testdata/sf0.001"
STATEMENTS = catalog_oracle()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLE_SCHEMAS:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return connection


def normal(row, order):
    return tuple(float(f"{row[i]:.9g}") if isinstance(row[i], float) else row[i] for i in order)


def by_text(row):
    return tuple((value is None, str(value)) for value in row)


@pytest.mark.parametrize("key", STATEMENTS)
def test_query_equals_statement(spark, database, key):
    frame = catalog_queries()[key](spark, FOLDER)
    cursor = database.execute(STATEMENTS[key])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    columns = sorted(names)
    expected = [normal(row, [names.index(c) for c in columns]) for row in cursor.fetchall()]
    found = [normal(row, [frame.columns.index(c) for c in columns]) for row in frame.collect()]
    assert sorted(found, key=by_text) == sorted(expected, key=by_text)


def test_every_statement_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_has_one_row(spark):
    assert entry_points.entry(spark).count() == 1
