"""Bounds that spare texts a shuffle: counts of large sets, and masks of ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tallyhouse.llm import jaccard

PERCENT = 80


def described(sets):
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value = np.array([x for s in sets for x in sorted(s)], np.uint64)
    return jaccard.bucket_counts(row, value, len(sets)), jaccard.odd_sketches(row, value, len(sets))


def allowed_by_sketch(one, two, sizes):
    apart = sum(int(x).bit_count() for x in (one ^ two).view(np.uint64))
    return (100 + PERCENT) * apart <= (100 - PERCENT) * sizes


def test_counts_part_large_sets_that_sketches_do_not():
    rng = np.random.default_rng(1)
    for size in (1500, 3000, 9000):
        sets = [set(rng.integers(0, 1 << 63, size).tolist()) for _ in range(2)]
        counts, sketches = described(sets)
        sizes = np.array([sum(map(len, sets))])
        assert allowed_by_sketch(*sketches, sizes[0])
        assert not jaccard.counts_allow(pa.array(counts[:1], pa.binary()), pa.array(counts[1:], pa.binary()), sizes, PERCENT).any()


def test_counts_lose_no_link():
    rng = np.random.default_rng(2)
    for _ in range(120):
        base = rng.integers(0, 1 << 63, int(rng.choice([20, 500, 900, 5000, 200_000], p=[0.2, 0.3, 0.3, 0.19, 0.01]))).tolist()
        gone = int(len(base) * rng.uniform(0, 0.15))
        sets = [set(base), set(base[gone:]) | set(rng.integers(0, 1 << 63, int(gone * rng.uniform(0, 0.7))).tolist())]
        counts, _ = described(sets)
        both = 100 * len(sets[0] & sets[1]) >= PERCENT * len(sets[0] | sets[1])
        got = jaccard.counts_allow(pa.array(counts[:1], pa.binary()), pa.array(counts[1:], pa.binary()), np.array([sum(map(len, sets))]), PERCENT)
        assert got.all() or not both
    assert jaccard.counts_allow(pa.array([None, b""], pa.binary()).slice(0, 1), pa.array([None], pa.binary()), np.array([9]), PERCENT).all()


def test_texts_of_ids_equal_a_semi_join(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("if(id % 50 = 0, NULL, id - id % 3) AS doc_id", "concat('text ', id) AS text")
    for n, bits in ((40, 1 << 24), (40, 64), (0, 64), (3000, 128)):
        monkeypatch.setattr(jaccard, "FILTER_BITS", bits)
        ids = spark.range(n).selectExpr("id * 7 - 30 AS doc_id").distinct()
        found = sorted(map(tuple, jaccard._texts_of(docs, ids).collect()))
        assert found == sorted(map(tuple, docs.join(ids, "doc_id", "left_semi").collect()))


def test_masks_come_before_the_shuffle_of_texts(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    plan = jaccard._texts_of(docs, spark.range(10).selectExpr("id * 7 AS doc_id").distinct())._jdf.queryExecution().executedPlan().toString()
    lines = [line.strip(" :+-*()0123456789") for line in plan.splitlines()]
    merge = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    mask = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line)
    assert merge < mask and any("Exchange hashpartitioning" in line for line in lines[merge:mask])
