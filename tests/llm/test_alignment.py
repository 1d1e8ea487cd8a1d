"""Alignment of two tokenizers against a plain one, token by token."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyhouse.llm import alignment
from tallyhouse.llm.bpe import byte_alphabet
from tallyhouse.llm.chunks import byte_chunks, piece_chunks
from tallyhouse.llm.session import prepare

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [
    (1, None), (2, ""), (None, "a  b \n\n c"), (None, "x ▁ y"), (5, " lead"), (5, "trail "), (6, "<|endoftext|><s>你好 😀 𐍈"),
    (7, " "), (8, "\n"), (9, "the the the" * 300), (10, "ñandú" * 3), (11, "0" * 3000), (12, "   "), (13, "<0x41> </s>"), (9, "the the the" * 300),
]


def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.no_truncation()
    a.no_padding()
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute_force(rows):
    first, second = tokenizers()
    alphabet, names = byte_alphabet(), {i: t for t, i in first.get_vocab().items()}
    spelt_b = lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
    documents, counts = [], Counter()
    for doc_id, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text, num_threads=1) if text else []
        a_bytes, b_bytes = [bytes(alphabet[c] for c in names[i]) for i in a], [spelt_b(i) for i in b]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            documents.append((doc_id, [], [], [], []))
            continue
        a_ends, b_ends = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
        links, j = [], 0
        for i, end in enumerate(a_ends):
            start = end - len(a_bytes[i])
            while b_ends[j] <= start:
                j += 1
            k = j
            while k < len(b) and b_ends[k] - len(b_bytes[k]) < end:
                links.append((a[i], b[k]))
                k += 1
        groups, i, j = [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            until_a, until_b = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
            groups.append(",".join(map(str, a[i:until_a])) + "|" + ",".join(map(str, b[j:until_b])))
            i, j = until_a, until_b
        counts.update(links)
        documents.append((doc_id, a, b, groups, links))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, a, b, groups, links in documents:
        shown = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), shown))
    return sorted(out, key=str)


def found(docs):
    return sorted((tuple(row) for row in alignment.aligned_documents(docs).select(*COLUMNS).collect()), key=str)


def test_odd_texts(spark):
    docs = prepare(spark).createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS n_a", "3 AS codes")
    assert found(docs) == brute_force(ODD)
    assert found(docs.where("false")) == []


def test_given_documents_over_many_blocks(spark, monkeypatch):
    """Blocks of a few documents each: counts of a pair come from all of them."""
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 100_000)
    docs = prepare(spark).read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(docs.repartition(3)) == brute_force([(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("texts", [[], [None, ""], ["one"]])
def test_blocks_of_few_rows(texts):
    import pyarrow as pa

    tool = alignment.aligner(alignment.BYTE_VOCABULARY, alignment.PIECE_VOCABULARY)
    block = tool.block(pa.array(range(len(texts)), pa.int64()), texts)
    assert block.num_rows == len(texts) + 1


def test_chunks_equal_whole_texts():
    """Texts cut at spaces have the ids of the tokenizers, whatever stands around the spaces."""
    import random

    rng = random.Random(4)
    parts = [" ", " ", "  ", "   ", "\n", "\t", "a", "the", "The", "é", "ñ", "你", "😀", "1", "23", "'s", "'", ".", ",", "!", "<|endoftext|>", "<s>", " ", "　", "\x85", "\x1c", "\r", "_", "ing", "▁", "́", "x" * 30, "ǅ", "Ⅷ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(3000)]
    plain, second = tokenizers()
    special = tokenizers()[0]
    special.encode_special_tokens = False
    a, with_specials, b = byte_chunks(plain_specials=True), byte_chunks(), piece_chunks()
    for begin in range(0, len(texts), 300):
        some = texts[begin : begin + 300]
        assert [x.tolist() for x in a.encode_spaced(some)] == [plain.encode(" " + t, add_special_tokens=False).ids for t in some]
        assert [x.tolist() for x in with_specials.encode_many(some)] == [special.encode(t, add_special_tokens=False).ids for t in some]
        for text, ids in zip(some, b.exact_spaced(some), strict=True):
            want = second.encode(text, num_threads=1)
            exact = b"".join(b.tokens[i] for i in want) == (" " + text).encode()
            assert ids.tolist() == want if exact else int(b.lengths[ids].sum()) != len(text.encode()) + 1
