"""What the driver reads for training."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.llm import quality
from tallyhouse.llm.session import prepare


def test_one_text_per_labelled_id_reaches_the_driver(spark, monkeypatch):
    ids = [r["id"] for r in prepare(spark).range(40).where(~quality.held_out(F.col("id"))).orderBy("id").limit(3).collect()]
    texts = [(ids[0], f"text {i:04d} é") for i in range(3000)] + [(ids[1], None), (ids[1], "Zebra"), (ids[1], "apple"), (ids[2], "one"), (None, "no id")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int")
    sizes = []
    kind = type(docs)
    monkeypatch.setattr(kind, "collect", lambda self, f=kind.collect: (lambda rows: sizes.append(len(rows)) or rows)(f(self)))
    assert quality.training_rows(docs, labels) == (["text 0000 é".encode(), b"Zebra", b"one"], [0, 1, 0])
    assert max(sizes) == 3
