"""Byte-level ids of whole texts: very long chunks stand between others, and nothing is kept from text to text."""

from __future__ import annotations

import random
import time

import public_tokenizers
from tokenizers import Tokenizer

from tallyhouse.llm.bpe import LONG_CHUNK
from tallyhouse.llm.chunks import BYTE_VOCABULARY, byte_chunks


def whole():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(BYTE_VOCABULARY))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_long_chunks_between_others():
    rng = random.Random(5)
    parts = ["a", "word,", "é", "x" * LONG_CHUNK, "y" * (LONG_CHUNK + 1), "ab" * 400, "1\n2", "\n", "", " ", "don't", "<|endoftext|>", "日本", "z" * 199 + "\t"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(600)]
    tokenizer = whole()
    assert [x.tolist() for x in byte_chunks().encode_many(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    tokenizer.encode_special_tokens = True
    found = byte_chunks(plain_specials=True).encode_spaced(texts)
    assert [x.tolist() for x in found] == [tokenizer.encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_texts_of_new_words_need_no_time_for_words():
    """Texts that share no words are encoded in less than the tokenizer's own time."""
    texts = [" ".join(f"w{(i * 997 + j) * 7919 % 9999991:x}q" for j in range(500)) for i in range(400)]
    tokenizer, tool = whole(), byte_chunks()
    tool.encode_many(texts[:5])
    begun = time.thread_time()
    found = tool.encode_many(texts)
    took = time.thread_time() - begun
    begun = time.thread_time()
    assert [x.tolist() for x in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert took < time.thread_time() - begun
    assert not hasattr(tool, "__len__"), "chunks are kept"
