"""What the driver gets for the dictionary of token files is bounded, whatever the ids are."""

from __future__ import annotations

import pytest
import zstandard

from tallyhouse.llm import token_files
from tallyhouse.llm.session import prepare

CASES = {
    "no ids": ("CAST(NULL AS bigint) AS doc_id", "concat('text ', id) AS text"),
    "one id for a third": ("if(id % 3 = 0, 7, id) AS doc_id", "concat('text ', id) AS text"),
    "equal rows": ("7L AS doc_id", "'the same text' AS text"),
    "null texts": ("id AS doc_id", "CAST(NULL AS string) AS text"),
    "long texts": ("id AS doc_id", "repeat('some words ', 20000) AS text"),
}


@pytest.mark.parametrize("case", CASES)
def test_sample_is_bounded(spark, case, monkeypatch):
    seen = []

    def train(size, samples):
        seen.extend(samples)
        raise zstandard.ZstdError("enough")

    monkeypatch.setattr(token_files.zstandard, "train_dictionary", train)
    rows = 40 if case == "long texts" else 3000
    docs = prepare(spark).range(rows).selectExpr(*CASES[case])
    assert token_files.trained_dictionary(docs, sample_docs=20) == b""
    assert len(seen) <= 20 and all(len(sample) <= token_files.SAMPLE_BYTES for sample in seen)
    assert len(seen) == (1 if case == "equal rows" else 20)


def test_files_of_rows_without_ids(spark):
    docs = prepare(spark).range(60).selectExpr("if(id < 50, NULL, id) AS doc_id", "if(id % 7 = 0, NULL, concat('word ', id % 5)) AS text")
    found = token_files.token_file_report(docs).orderBy("start").collect()
    assert len(found) == 60 and found[0].start == 0
    assert all(b.start == a.start + a.n_tokens for a, b in zip(found, found[1:]))
    assert [r.doc_id for r in found] == [None] * 50 + list(range(50, 60))
    assert token_files.token_file_report(docs.limit(0)).count() == 0
