"""Registered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import alignment, bpe, decontaminate, fingerprints, html, jaccard, merkle, packing, preferences, quality, secrets, substrings, token_files
from tallyhouse.llm.session import table


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontamination_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op1_repeated_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.removal_report(table(spark, folder, "documents"))


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_file_report(table(spark, folder, "documents"))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.extraction_report(table(spark, folder, "pages"))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_report(table(spark, folder, "documents"))


def op6_preference_format(spark: SparkSession, folder: str) -> DataFrame:
    return preferences.preference_report(table(spark, folder, "conversations"))


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.grouped(table(spark, folder, "documents"), length=3, percent=90)


def op8_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip_report(table(spark, folder, "documents"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_report(table(spark, folder, "documents"))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned_documents(table(spark, folder, "documents"))


def op12_balanced_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.tampering_report(table(spark, folder, "documents"))


QUERIES = (
    op1_repeated_substrings,
    op2_token_files,
    op3_html_extraction,
    op4_secret_scan,
    op5_benchmark_decontamination,
    op6_preference_format,
    op7_jaccard_join,
    op8_bpe_round_trip,
    op9_quality_classifier,
    op10_order_minhash,
    op11_token_alignment,
    op12_balanced_packing,
    op13_merkle_manifest,
)


def corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query per dealt operator."""
    return {query.__name__: query for query in QUERIES}


def corpus_oracle() -> dict[str, str]:
    """DuckDB statement where SQL expresses the result and is quick on whole tables."""
    return {"op6_preference_format": preferences.PREFERENCE_SQL}
