"""Near duplicates among rows whose ids are null or repeat."""

from __future__ import annotations

from tallyhouse.llm import jaccard
from tallyhouse.llm.session import prepare


def test_one_row_of_each_group_stays(spark):
    texts = [" ".join(f"{name}{i}" for i in range(60)) for name in "abcdef"]
    near = lambda text: f"{text} more"
    rows = [
        (7, texts[0], "x"), (7, near(texts[0]), "y"), (7, texts[1], "z"),  # copies with one id, and another text of that id
        (None, texts[2], "x"), (None, texts[2], "x"), (None, near(texts[2]), "x"),
        (3, texts[3], "x"), (3, texts[3], "x"), (9, texts[3], "x"), (None, texts[3], "x"),
        (1, near(texts[4]), "x"), (2, texts[4], "x"),
        (5, "", "x"), (5, "", "x"), (None, None, "x"),  # nothing to link
    ]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string, tie string")
    kept = [tuple(r) for r in jaccard.keep_first(docs).collect()]
    of = lambda text: [r for r in kept if r[1] in (text, near(text))]
    assert [len(of(t)) for t in texts] == [1, 1, 1, 1, 1, 0]
    assert of(texts[3]) == [(3, texts[3], "x")] and of(texts[4]) == [(1, near(texts[4]), "x")]
    assert sorted((r for r in kept if not r[1]), key=str) == sorted([(5, "", "x"), (5, "", "x"), (None, None, "x")], key=str)
    assert jaccard.keep_first(docs).columns == docs.columns
