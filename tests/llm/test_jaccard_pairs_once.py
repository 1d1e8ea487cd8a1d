"""A pair of documents that shares many open signatures leaves the join at the first of them, and none is lost."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import jaccard
from tallyhouse.llm.session import prepare


@pytest.mark.parametrize("listed", [1, 16])
def test_pairs_leave_the_join_about_once(spark, listed, monkeypatch):
    monkeypatch.setattr(jaccard, "LISTED", listed)
    rng = random.Random(3)
    members = {sig: rng.sample(range(12), 8) for sig in range(40)}
    rows = [(sig * 7919 % 1009 - 500, doc, doc % 4) for sig, docs in members.items() for doc in docs]
    open_ = prepare(spark).createDataFrame(rows, "sig long, doc long, doc_in long")
    sketched = spark.range(12).select(F.col("id").alias("doc_id"), F.lit(100).alias("n_shingles"), *[F.lit(0).cast("long").alias(s) for s in jaccard.SKETCH])
    made = [(r.a, r.b) for r in jaccard._pairs_across(open_, sketched, 90).collect()]
    want = {(a, b) for docs in members.values() for a in docs for b in docs if a < b and a % 4 != b % 4}
    assert set(made) == want
    if listed == 16:
        shared = sum(1 for docs in members.values() for a in docs for b in docs if a < b and a % 4 != b % 4)
        assert len(made) < 2 * len(want) < shared
