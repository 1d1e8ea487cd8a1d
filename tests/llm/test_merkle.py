"""The Merkle manifest against a plain one, on trees of any shape."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import merkle
from tallyhouse.llm.session import prepare

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lowered=False):
    out = ""
    for name in merkle.FIELDS:
        value = row[name]
        if value is None:
            out += "-"
            continue
        text = str(value)
        if lowered and name == "text":
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        out += f"{len(text.encode())}:{text}"
    return digest(out)


def built(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    return levels


def climbed(levels, at):
    for level in levels[:-1]:
        begin = at // 16 * 16
        yield level[begin : begin + 16], at - begin
        at //= 16


def brute_force(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    order = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    trees = {}
    for name in order:
        members = sorted(groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[name] = members, built([leaf(r) for r in members])
    top = built([trees[name][1][-1][0] for name in order])
    out = []
    for rank, name in enumerate(order):
        members, levels = trees[name]
        for at, row in enumerate(members):
            path = [*climbed(levels, at), *climbed(top, rank)]
            proof = "".join("".join(run[:slot] + run[slot + 1 :]) for run, slot in path)
            carried = leaf(row, row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
            for run, slot in path:
                carried = digest("".join([*run[:slot], carried, *run[slot + 1 :]]))
            out.append((row["doc_id"], leaf(row), levels[-1][0], top[-1][0], digest(proof), carried, carried == top[-1][0]))
    return sorted(out, key=str)


def found(docs):
    return sorted((tuple(row) for row in merkle.tampering_report(docs).select(*COLUMNS).collect()), key=str)


def corpus(spark, n):
    """A hot source, a null one, many others, null and repeated ids, repeated rows, and columns with clashing names."""
    return prepare(spark).range(n).selectExpr(
        "if(id % 97 = 0, NULL, id - id % 2 * (id % 5)) AS doc_id",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('é', id % 40) END AS source",
        "if(id % 11 = 0, NULL, 'en') AS lang",
        "if(id % 13 = 0, NULL, id % 17) AS n_chars",
        "CASE WHEN id % 19 = 0 THEN NULL WHEN id % 23 = 0 THEN '' ELSE concat('Text É ', id % 300) END AS text",
        "'clash' AS leaf",
        "1 AS tree",
        "2 AS place",
    )


def test_given_documents(spark):
    docs = prepare(spark).read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(docs) == brute_force([row.asDict() for row in docs.collect()])


def test_odd_rows_and_blocks_of_leaves(spark, monkeypatch):
    """Nodes above the first level are stored per block of 16 leaves here, as those above 4,096 are elsewhere."""
    docs = corpus(spark, 1500).union(corpus(spark, 3))
    want = brute_force([row.asDict() for row in docs.collect()])
    assert found(docs) == want
    monkeypatch.setattr(merkle, "BLOCK_LEVEL", 2)
    monkeypatch.setattr(merkle, "BLOCK", 256)
    assert found(docs) == want


@pytest.mark.parametrize("condition", ["false", "doc_id = 7", "source = 'hot' AND doc_id < 40", "source = 'é1'"])
def test_small_tables(spark, condition):
    docs = corpus(spark, 300).where(condition)
    assert found(docs) == brute_force([row.asDict() for row in docs.collect()])


def test_several_rows_of_one_block_serve_no_more_leaves_than_it_has(spark):
    docs = corpus(spark, 9000)
    manifest = merkle.build_manifest(docs, "doc_id", "source", merkle.row_hash([F.col(name) for name in merkle.FIELDS]))
    leaves = manifest.families.groupBy("tree", "step", "up_place").agg(F.sum(F.size("members")).alias("n")).agg(F.max("n")).first()[0]
    assert leaves <= merkle.BLOCK
    assert manifest.runs.groupBy("tree", "step", "place").count().where("count > 1").isEmpty()
