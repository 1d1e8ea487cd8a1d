"""Token ids of whole texts by way of their space-separated chunks.

A byte-level vocabulary cuts a text before every space that stands next to something else than white space, and a
sentence-piece vocabulary whose pieces hold no inner word mark cuts it before every single space. Both then give a
chunk the same ids wherever it stands. Texts where that does not hold (runs of spaces, special tokens) are encoded whole by the
tokenizer itself; so are very long chunks. All other chunks go through the faster byte-level encoder, text by text. Those
of sentence pieces are encoded once per worker; that memory is bounded by ``CHUNKS_KEPT`` and changes the speed, never the
result.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import chain

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from tallyhouse.llm.bpe import CHUNKS_KEPT, LONG_CHUNK, OPEN_SPACE, byte_alphabet

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
LONG_CHUNKS = re.compile(rf"( [^ ]{{{LONG_CHUNK + 1},}})")


def file_of(vocabulary: str) -> str:
    """The file of a name of the public tokenizers, or the path itself."""
    return vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)


class ByteChunks:
    """Ids of texts by a byte-level BPE vocabulary; what lies between very long chunks is encoded in one call."""

    def __init__(self, path: str, plain_specials: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the workers of an executor share its cores already
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain_specials
        self.specials = [] if plain_specials else [x["content"] for x in content["added_tokens"]]
        alphabet = byte_alphabet()
        added = {x["content"] for x in content["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in content["model"]["vocab"].items() if token not in added}
        self.fast = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = max([*ranks.values(), *[x["id"] for x in content["added_tokens"]]]) + 1
        self.width = "<u2" if size <= 1 << 16 else "<u4"
        self.lengths = np.zeros(size, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)
        self.tokens: list[bytes] = [b""] * size
        for token, i in ranks.items():
            self.tokens[i] = token

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width)

    def _separable(self, spaced: str) -> bool:
        """Whether a space and the chunks behind it keep their ids wherever they are cut."""
        return not OPEN_SPACE.search(spaced) and not any(s in spaced for s in self.specials)

    def _spaced(self, spaced: str) -> list[np.ndarray]:
        """Ids of separable chunks with a space before each; only the tokenizer itself encodes very long ones."""
        parts = LONG_CHUNKS.split(spaced)
        return [self._whole(part) if i % 2 else self.fast.encode_to_numpy(part).astype(self.width) for i, part in enumerate(parts) if part]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text."""
        text = text or ""
        first, space, rest = text.partition(" ")
        plain = space and first and not first[-1].isspace() and self._separable(" " + rest) and not any(s in first for s in self.specials)
        return np.concatenate([self._whole(first), *self._spaced(" " + rest)]) if plain else self._whole(text)

    def encode_many(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of texts."""
        return [self.encode(text) for text in texts]

    def encode_spaced(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts with a space before each."""
        return [np.concatenate(self._spaced(" " + text)) if self._separable(" " + text) else self._whole(" " + text) for text in texts]


def _parted(known: dict[str, bytes], chunks: list[str], ids: np.ndarray, lengths: np.ndarray) -> bool:
    """Part the ids of chunks that spell them with a space before each; nothing is kept if a token crosses chunks."""
    ends = np.cumsum(lengths[ids])
    bounds = np.cumsum([len(chunk.encode()) + 1 for chunk in chunks])
    cuts = np.searchsorted(ends, bounds)
    if not len(ends) or ends[-1] != bounds[-1] or (ends[np.minimum(cuts, len(ends) - 1)] != bounds).any():
        return False
    blob, size = ids.tobytes(), ids.dtype.itemsize
    places = [0, *((cuts + 1) * size).tolist()]
    known.update(zip(chunks, map(blob.__getitem__, map(slice, places[:-1], places[1:])), strict=True))
    return True


class PieceChunks(dict):
    """Chunks -> packed ids; the vocabulary adds the space before them itself."""

    def __init__(self, path: str):
        super().__init__()
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.processor.get_piece_size()
        pieces = [self.processor.id_to_piece(i) for i in range(size)]
        self.width, self.code = ("<u2", "H") if size <= 1 << 16 else ("<u4", "I")
        self.tokens = [bytes([int(p[3:5], 16)]) if self.processor.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        # Pieces with a word mark behind another character would join chunks.
        self.separable = not any(MARK in p.lstrip(MARK) for i, p in enumerate(pieces) if not self.processor.is_byte(i))

    def __missing__(self, chunk: str) -> bytes:
        got = self._exact(chunk)
        if len(chunk) <= LONG_CHUNK:
            self[chunk] = got
        return got

    def _exact(self, text: str) -> bytes:
        """Packed ids of a text; none if they do not spell a space and the text."""
        ids = self.processor.encode(text, num_threads=1)
        spelt = b"".join(map(self.tokens.__getitem__, ids)) == b" " + text.encode()
        return array(self.code, ids).tobytes() if spelt else b""

    def learn(self, chunks: set[str]) -> None:
        """Encode new chunks in one call and check what all of them spell; where that differs, each goes alone."""
        new = [c for c in chunks if c not in self and 0 < len(c) <= LONG_CHUNK]
        if len(self) + len(new) > CHUNKS_KEPT:
            self.clear()
            new = [c for c in chunks if 0 < len(c) <= LONG_CHUNK]
        if not new:
            return
        ids = np.fromiter(chain.from_iterable(self.processor.encode(new, num_threads=1)), self.width)
        if b"".join(map(self.tokens.__getitem__, ids.tolist())) == (" " + " ".join(new)).encode():
            _parted(self, new, ids, self.lengths)

    def exact_spaced(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts with a space before each; fewer bytes than that where the vocabulary cannot spell a text."""
        joined = lambda text: not self.separable or "  " in text or MARK in text or text[:1] == " " or text[-1:] == " "
        parted = [None if joined(text) else text.split(" ") for text in texts]
        self.learn(set().union(*[part for part in parted if part]))
        packed = [self._exact(text) if part is None else b"".join(map(self.__getitem__, part)) for text, part in zip(texts, parted, strict=True)]
        return [np.frombuffer(ids, self.width) for ids in packed]


_BYTE: dict[tuple[str, bool], ByteChunks] = {}
_PIECE: dict[str, PieceChunks] = {}


def byte_chunks(vocabulary: str = BYTE_VOCABULARY, plain_specials: bool = False) -> ByteChunks:
    """The byte-level encoder of a vocabulary, one per process."""
    key = vocabulary, plain_specials
    if key not in _BYTE:
        _BYTE[key] = ByteChunks(file_of(vocabulary), plain_specials)
    return _BYTE[key]


def piece_chunks(vocabulary: str = PIECE_VOCABULARY) -> PieceChunks:
    """The sentence-piece encoder of a vocabulary, one per process."""
    if vocabulary not in _PIECE:
        _PIECE[vocabulary] = PieceChunks(file_of(vocabulary))
    return _PIECE[vocabulary]
