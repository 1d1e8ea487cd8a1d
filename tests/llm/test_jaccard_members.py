"""Signatures with equal members are compared once, and no link is lost by that."""

from __future__ import annotations

import random

from tallyhouse.llm import jaccard
from tallyhouse.llm.session import prepare


def test_one_signature_for_every_set_of_members(spark):
    rows = [(1, 10, 5, 10), (1, 11, 5, 11), (1, 5, 5, 5), (2, 10, 6, 10), (2, 11, 6, 11), (2, 6, 6, 5), (3, 10, 5, 10), (3, 12, 5, 12), (3, 11, 5, 11), (4, 10, 5, 7), (4, 11, 5, 7), (5, 13, 5, 13), (5, 5, 5, 5)]
    placed = prepare(spark).createDataFrame(rows, "sig long, doc long, center long, doc_in long")
    assert sorted(r.sig for r in jaccard._different_signatures(placed).collect()) == [1, 3]


def test_chains_of_near_copies(spark):
    """Each text is near the next one only, so centers alone do not join them."""
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    texts = []
    for _ in range(40):
        texts.append(" ".join(words))
        words[rng.randrange(60)] = f"w{rng.randrange(10**6)}"
    docs = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.grouped(docs, length=3, percent=80).collect()}
    sets = [{tuple(t.split()[i : i + 3]) for i in range(58)} for t in texts]
    want = list(range(40))
    for i in range(40):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = want[i], want[j]
                want = [min(a, b) if x in (a, b) else x for x in want]
    assert [found[i] for i in range(40)] == want
