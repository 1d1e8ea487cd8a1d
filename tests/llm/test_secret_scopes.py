"""Linking of credential parts over whole scopes."""

from __future__ import annotations

import pytest

from tallyhouse.llm import secrets
from tallyhouse.llm.session import prepare

FILLER = "# a comment of the configuration\n" * 400
PARTS = {"named_id": "login: alice", "weak_secret": "pwd: hunter22", "endpoint": "https://db.example.com/x"}


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_parts_far_apart_in_one_scope_are_linked(end):
    text = f"\n{FILLER}".join(PARTS.values()).replace("\n", end)
    assert {text[a:b]: kind for kind, a, b in secrets.text_spans(text)} == {part: kind for kind, part in PARTS.items()}
    # One scope has identifier and secret, the other an address alone.
    text = f"login: alice\n{FILLER}pwd: hunter22\n \nsee https://db.example.com/x".replace("\n", end)
    assert [kind for kind, _, _ in secrets.text_spans(text)] == ["named_id", "weak_secret"]
    assert secrets.text_spans(f"login: alice{end}{end}pwd: hunter22") == []


def test_parts_far_apart_are_masked(spark):
    text = f"\n{FILLER}".join(PARTS.values())
    docs = prepare(spark).createDataFrame([(1, text, len(text))], "doc_id long, text string, n_chars long")
    row = secrets.redact_secrets(docs).first()
    assert row["text"] == f"{secrets.MASK}\n{FILLER}{secrets.MASK}\n{FILLER}{secrets.MASK}" and row["n_chars"] == len(row["text"])
