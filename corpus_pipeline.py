"""Corpus preparation: five stages over the documents, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the
columns of the documents. Empty tables pass through; rows with null texts are empty texts to every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import bpe, decontaminate, jaccard, quality, secrets
from tallyhouse.llm.session import prepare, stored, table

# A convolutional network, exact set similarity and regular expressions: not expressible in SQL.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from the labels of the documents given."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by similar sets of five-word shingles (0.8 or more), the smallest doc_id stays."""
    prepare(spark)
    return jaccard.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets and linked credentials are masked in the texts."""
    prepare(spark)
    return secrets.redact_secrets(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and whether decoding them gives the text again."""
    prepare(spark)
    return bpe.encode_checked(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", first_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", secrets_masked),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


def corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The pipeline as a registered query."""
    return {"pipeline": run}


def corpus_oracle() -> dict[str, str]:
    """Its DuckDB statement, if SQL can express it."""
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
