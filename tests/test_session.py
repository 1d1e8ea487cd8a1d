from __future__ import annotations

import os

import pytest

from tallyhouse import session
from tallyhouse.session import INITIAL_PARTITIONS, size_shuffles
from tallyhouse.sources.testbed import Testbed


def test_shuffles_grow_with_the_input_and_never_shrink(spark):
    table = Testbed(spark, "/root/testdata/sf0.01")["lineitem"]
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        assert size_shuffles(spark, table) == usual
        grown = size_shuffles(spark, table, bytes_per_partition=50_000)
        assert grown > usual and spark.conf.get(INITIAL_PARTITIONS) == str(grown)
        assert size_shuffles(spark, table) == grown
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)


def test_scratch_is_below_the_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_shared_setting", lambda _: str(tmp_path))
    first, second = session.scratch_folder(spark, "x"), session.scratch_folder(spark, "x")
    assert first.startswith(f"{tmp_path}/x-") and first != second
    monkeypatch.setattr(session, "_shared_setting", lambda _: None)
    local = session.scratch_folder(spark, "x")
    assert os.path.isdir(os.path.dirname(local))
    assert os.path.dirname(session.scratch_folder(spark, "y")) == os.path.dirname(local)


@pytest.mark.parametrize(
    ("view", "count"),
    [
        ("mk_customers", 1500), ("mk_orders", 15_000), ("mk_items", 60_000), ("mk_payments", 60_000),
        ("mk_reviews", 60_000), ("mk_products", 2000), ("mk_categories", 5), ("mk_sellers", 100), ("mk_geo", 1500),
    ],
)
def test_view_sizes(spark, view, count):
    assert Testbed(spark, "/root/testdata/sf0.01")[view].count() == count
