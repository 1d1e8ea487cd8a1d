"""What a step of the pipeline leaves behind in the Python workers that later stages get."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

from tallyhouse.llm import bpe


def test_workers_forget_the_chunks_of_a_step(spark):
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            tools = bpe._ENCODERS.values()
            n = sum(len(t) + len(t.older) + len(t.vocabulary.pairs) for t in tools)
            yield pa.RecordBatch.from_arrays([pa.array([len(tools)]), pa.array([n])], ["tools", "held"])

    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('some words, word', id, ' and x', id * 7) AS text").repartition(4)
    assert bpe.encode_checked(docs).where("NOT round_trip OR n_tokens < 4").count() == 0
    left = spark.range(0, 400, 1, 4).mapInArrow(held, "tools long, held long").collect()
    assert any(r.tools for r in left), "no worker was used again"
    assert all(r.held == 0 for r in left)


def test_a_step_with_few_kept_chunks_gives_the_same_ids():
    tool = bpe.encoder()
    texts = [" ".join(f"word{(i * j) % 101}," for j in range(60)) for i in range(1, 20)]
    usual = [tool.encode(t).tolist() for t in texts]
    tool.forget()
    tool.kept = 7
    try:
        assert [tool.encode(t).tolist() for t in texts] == usual
        assert len(tool) <= 7 and len(tool.older) <= 7
    finally:
        tool.forget()
        tool.kept = bpe.CHUNKS_KEPT
