"""Items that repeat an id, and the longest verbatim match, at one block of items and at several."""

from __future__ import annotations

import random

import pytest

from tallyhouse.llm import decontaminate
from tallyhouse.llm.session import prepare

WINDOW = 10


def longest_by_rule(text, items):
    mine, best = text.split(), 0
    for item in (i.split() for i in items):
        for p in range(len(mine)):
            for q in range(len(item)):
                n = 0
                while p + n < len(mine) and q + n < len(item) and mine[p + n] == item[q + n]:
                    n += 1
                if n >= WINDOW or n == len(item):
                    best = max(best, n)
    return best


@pytest.mark.parametrize("block", [1 << 20, 64])
def test_ids_count_once_and_longest_stays_in_one_item(spark, block):
    draw = random.Random(3)
    words = lambda n, letters="abcdefghijklmnop": " ".join(draw.choice(letters) + draw.choice("xyz") for _ in range(n))
    passage = words(40)
    part = passage.split()
    # A short item begins inside the passage; two items overlap in the middle of a text that neither holds whole.
    items = [(1, passage), (1, " ".join(part[5:30])), (2, " ".join(part[7:10])), (3, words(30)), (4, " ".join(["a", "b"] * 30)), (4, " ".join(["a", "b"] * 30))]
    tail = items[3][1].split()
    items += [(5, " ".join(tail[8:] + words(12).split()))]
    texts = [f"start {passage} stop", f"{items[3][1]} {' '.join(items[6][1].split()[22:])}", " ".join(["b", "a"] * 50), " ".join(part[7:10]), "nothing", ""]
    texts += [" ".join(draw.choice([part, tail])[i : i + draw.randint(1, 30)][0] for i in range(12)) for _ in range(5)]
    benchmark = prepare(spark).createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in decontaminate.matches(docs, benchmark, item_block_bytes=block).collect()}
    for i, text in enumerate(texts):
        assert rows[i]["match_longest"] == longest_by_rule(text, [t for _, t in items]), i
        assert len(set(rows[i]["match_items"])) == len(rows[i]["match_items"])
    assert sorted(rows[0]["match_items"]) == [1, 2] and rows[2]["match_items"] == [4]
