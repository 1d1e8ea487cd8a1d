"""Packing: every id in one piece, full sequences, balanced costs."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import packing
from tallyhouse.llm.session import prepare

SMALL = "/root/testdata/sf0.001/documents.parquet"
ODD = [(1, None), (2, ""), (None, "some text"), (None, "more of it"), (5, "a"), (5, "b"), (6, "word " * 9000), (7, "<|endoftext|> x"), (8, "   \n ")]


def ids_of(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return [[*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID] for text in texts]


def check(docs, **options):
    pieces = packing.packed(docs, **options).collect()
    rows = docs.select("doc_id", "text").collect()
    sequences = defaultdict(list)
    for piece in pieces:
        sequences[piece.sequence_id].append((piece.offset, piece.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.CAPACITY and (at == packing.CAPACITY or at & (at - 1) == 0)
    by_document = defaultdict(list)
    for row, ids in zip(rows, ids_of([row.text for row in rows]), strict=True):
        by_document[row.doc_id].append(ids)
    given = defaultdict(list)
    for piece in pieces:
        given[piece.doc_id].append(piece)
    for doc_id, own in by_document.items():
        if len(own) == 1:
            ids, at = own[0], 0
            for piece in sorted(given[doc_id], key=lambda p: p.start):
                assert (piece.start, piece.doc_tokens) == (at, len(ids))
                assert piece.ids_crc32 == zlib.crc32(np.array(ids[at : at + piece.length], "<u4").tobytes())
                at += piece.length
            assert at == len(ids)
        else:
            assert sum(piece.length for piece in given[doc_id]) == sum(map(len, own))
            assert Counter(piece.doc_tokens for piece in given[doc_id]).keys() == set(map(len, own))
    assert set(given) == set(by_document)
    return pieces


@pytest.mark.parametrize("options", [{}, {"group_tokens": 20_000}])
def test_given_documents(spark, options):
    check(prepare(spark).read.parquet(SMALL), **options)


def test_odd_rows(spark):
    docs = prepare(spark).createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 AS tail", "2 AS row", "3 AS `group`")
    pieces = check(docs)
    assert len({piece.sequence_id for piece in pieces if piece.doc_id == 6 and piece.length == packing.CAPACITY}) == 4
    assert packing.packed(docs.where("false")).count() == 0


def test_assignment_follows_the_rule():
    """Each piece goes to the sequence of least cost that has room for it, or to the largest room if none has."""
    rng = random.Random(2)
    for _ in range(30):
        lengths = [rng.choice([rng.randint(1, 40), rng.randint(1, 2047)]) for _ in range(rng.randint(0, 60))]
        room = packing.sequence_room(sum(lengths)).tolist()
        left, spent = list(room), [0.0] * len(room)
        last = None
        for document, start, length, sequence, offset in packing.assign(lengths):
            waiting = lengths[document] - start
            assert last is None or waiting <= last
            last = waiting
            fitting = [i for i, free in enumerate(left) if free >= waiting]
            if fitting:
                assert length == waiting and spent[sequence] == min(spent[i] for i in fitting) and sequence in fitting
            else:
                assert length == left[sequence] == max(left)
            assert offset == room[sequence] - left[sequence]
            left[sequence] -= length
            spent[sequence] += packing.cost(length)
        assert not any(left)


def test_costs_are_balanced():
    """Costs of full sequences differ less than where documents of that order take the first sequence with room."""
    rng = random.Random(3)
    lengths = [min(1500, int(rng.lognormvariate(5.5, 0.9)) + 1) for _ in range(3000)]
    full = sum(lengths) // packing.CAPACITY
    spent = defaultdict(float)
    pieces = packing.assign(lengths)
    for _, _, length, sequence, _ in pieces:
        spent[sequence] += packing.cost(length)
    left, plain = [packing.CAPACITY] * full, [0.0] * full
    for length in sorted(lengths, reverse=True):
        place = next((i for i, free in enumerate(left) if free >= length), None)
        if place is not None:
            left[place] -= length
            plain[place] += packing.cost(length)
    assert np.std([spent[i] for i in range(full)]) < 0.8 * np.std(plain)
    assert len(pieces) < 1.2 * len(lengths)
