"""Byte-level BPE by backtracking, and decoding through an offset table.

An Aho-Corasick automaton over the vocabulary finds the longest token at every byte of a piece. The encoder takes the
longest token that is compatible with the one before it; where none is, it marks the position as a dead end and goes
back one token. Two tokens are compatible if merging would have kept the boundary between them, which a memoised table
answers, so the result equals that of applying the merges in order, in linear time. Decoding gathers the bytes of all
ids from one array of token bytes and its offsets.

Texts are cut into pieces as the tokenizer does, and the pieces of each distinct chunk between spaces are encoded once by a
worker (memory is bounded by twice ``CHUNKS_KEPT`` chunks of up to ``LONG_CHUNK`` characters and ``PAIRS_KEPT`` pairs, which change the
speed, never the result). Spark gives a worker to later stages as well, so a step between others (``encode_checked``) keeps fewer
chunks and forgets them at the end of its task. Special tokens in a text become their ids.

Defined cases: a null or empty text has no ids and decodes to the empty text; ids outside the vocabulary raise;
an input column with the name of an added one is replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyhouse.llm.session import others

VOCABULARY = "byte_bpe_50k.json"
CHUNKS_KEPT = 300_000  # in each of two halves
STEP_CHUNKS_KEPT = 75_000  # the same for a step between others
PAIRS_KEPT = 400_000
LONG_CHUNK = 200
# Signs that are one piece behind a word.
STOPS = ".,;:!?"
# A space between white space, or between white space and the end: there the cut depends on more than one chunk.
OPEN_SPACE = re.compile(r"\s (?:\s|\Z)")

# The white space and the piece pattern of the byte-level pre-tokenizer.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Vocabulary:
    """Tokens as bytes, merges by rank, the automaton and the tables of the encoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        alphabet = byte_alphabet()
        as_bytes = lambda token: bytes(alphabet[c] for c in token)
        vocab = content["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in content["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens: list[bytes | None] = [None] * size
        for token, i in vocab.items():
            self.tokens[i] = token.encode() if token in self.special else as_bytes(token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.ids = {as_bytes(t): i for t, i in vocab.items() if t not in self.special}
        # Rank of a token: that of the merge that makes it; bytes come first. parts: the two tokens of that merge.
        self.rank, self.parts, self.merged = [-1] * size, [None] * size, {}
        for rank, merge in enumerate(content["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right = vocab[a], vocab[b]
            whole = vocab[a + b]
            self.merged[left, right] = rank
            if self.parts[whole] is None:
                self.rank[whole], self.parts[whole] = rank, (left, right)
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        self.automaton.make_automaton()
        self.shorter = {i: self._shorter(token) for token, i in self.ids.items()}
        self.lengths = [0 if t is None else len(t) for t in self.tokens]
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.blob = np.frombuffer(b"".join(t or b"" for t in self.tokens), np.uint8)
        self.pairs: dict[int, bool] = {}

    def _shorter(self, token: bytes) -> int | None:
        """Longest token that is a proper prefix."""
        for size in range(len(token) - 1, 0, -1):
            if (found := self.ids.get(token[:size])) is not None:
                return found
        return None

    def compatible(self, left: int, right: int) -> bool:
        """Whether the boundary between two adjacent tokens survives all merges."""
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[pair] = self._survives(left, right)
        return known

    def _survives(self, left: int, right: int) -> bool:
        """Undo the merges of both tokens from the last one; a merge across that came before the undone one wins.

        Merges run by rank, and equal ranks from the left: a merge across the boundary beats the undone merge of
        the left token if its rank is smaller, and that of the right token also if it is equal.
        """
        limit, equal_wins = len(self.rank), False
        while True:
            across = self.merged.get((left, right))
            if across is not None and (across < limit or equal_wins and across == limit):
                return False
            if self.parts[left] is None and self.parts[right] is None:
                return True
            if self.rank[left] > self.rank[right]:
                limit, equal_wins = self.rank[left], False
                left = self.parts[left][1]
            else:
                limit, equal_wins = self.rank[right], True
                right = self.parts[right][0]

    def piece_ids(self, piece: bytes) -> list[int]:
        """Ids of one piece: the run of longest tokens if all its pairs are compatible, else by backtracking."""
        text = piece.decode("latin-1")
        run = [i for _, (_, i) in self.automaton.iter_long(text)]
        known, before = self.pairs.get, run[0]
        for n, token in enumerate(run):
            if n:
                held = known(before << 32 | token)
                if held is None:
                    held = self.compatible(before, token)
                if not held:
                    return self._by_backtracking(text, run, n)
                before = token
        return run

    def _by_backtracking(self, text: str, run: list[int], n: int) -> list[int]:
        """Longest tokens first; one that is not compatible with the token before it gives way to a shorter one.

        The longest tokens of ``run`` are known and compatible up to the ``n``-th; the automaton is asked for that of another
        place when it is first needed.
        """
        lengths, shorter, known = self.lengths, self.shorter, self.pairs.get
        longest = [-1] * len(text)
        at = 0
        for token in run:
            longest[at] = token
            at += lengths[token]
        out = run[:n]
        at, token = sum([lengths[i] for i in out]), run[n]
        dead = bytearray(len(text) + 1)
        while True:
            end = at + lengths[token]
            if not dead[end]:
                held = True
                if out:
                    held = known(out[-1] << 32 | token)
                    if held is None:
                        held = self.compatible(out[-1], token)
                if held:
                    out.append(token)
                    at = end
                    if at == len(text):
                        return out
                    token = longest[at]
                    if token < 0:
                        token = longest[at] = next(self.automaton.iter_long(text, at))[1][1]
                    continue
            fallback = shorter[token]
            if fallback is None:
                dead[at] = 1
                token = out.pop()
                at -= lengths[token]
            else:
                token = fallback


class Encoder(dict):
    """Chunks already encoded, keyed without the space before them: packed ids and their decimal text.

    A text is cut at each space that stands next to something else than white space, as the tokenizer cuts it there too;
    where a space stands between white space, or a special token in the text, all its pieces are encoded in place.
    """

    def __init__(self, path: str):
        super().__init__()
        self.kept = CHUNKS_KEPT
        self.vocabulary = Vocabulary(path)
        self.pattern = regex.compile(PIECE)
        self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.vocabulary.special, key=len, reverse=True)) + ")") if self.vocabulary.special else None
        self.first = [s[:2] for s in self.vocabulary.special]
        self.older: dict[str, tuple[bytes, str]] = {}
        self.stops: dict[str, tuple[bytes, str]] = {}
        self.decimal = [str(i) for i in range(len(self.vocabulary.tokens))]

    def __missing__(self, chunk: str) -> tuple[bytes, str]:
        got = self.older.get(chunk)
        if got is None:
            word = chunk.rstrip(STOPS)
            if not word.isalpha():
                got = self._joined(self.pattern.findall(" " + chunk))
            elif len(word) < len(chunk):  # a word and the signs behind it are two pieces
                ids, shown = self[word]
                more, more_shown = self._stops(chunk[len(word) :])
                got = ids + more, f"{shown},{more_shown}"
            else:
                got = self._joined([" " + word])
        if len(chunk) <= LONG_CHUNK:
            if len(self) >= self.kept:
                # Chunks that are used again come back from the older half; the others go with it.
                self.older = dict(self)
                self.clear()
            self[chunk] = got
        return got

    def forget(self) -> None:
        """Drop all chunks and pairs; the vocabulary stays."""
        self.clear()
        self.older = {}
        self.stops = {}
        self.vocabulary.pairs.clear()

    def _stops(self, stops: str) -> tuple[bytes, str]:
        got = self.stops.get(stops)
        if got is None:
            got = self._joined([stops])
            if len(stops) < 3:
                self.stops[stops] = got
        return got

    def _joined(self, pieces: list[str]) -> tuple[bytes, str]:
        """Packed ids and decimal text of pieces."""
        find = self.vocabulary.piece_ids
        ids = find(pieces[0].encode()) if len(pieces) == 1 else [i for piece in pieces for i in find(piece.encode())]
        return array("I", ids).tobytes(), ",".join([self.decimal[i] for i in ids])

    def _pieces(self, text: str) -> list[tuple[bytes, str]]:
        """Packed ids and decimal text of the parts of a text, none of them empty."""
        if any(f in text for f in self.first):
            out = []
            for part in self.specials.split(text):
                if part in self.vocabulary.special:
                    i = self.vocabulary.special[part]
                    out.append((np.array([i], "<u4").tobytes(), str(i)))
                elif part:
                    out.append(self._joined(self.pattern.findall(part)))
            return out
        first, space, rest = text.partition(" ")
        if not space or not first or first[-1].isspace() or OPEN_SPACE.search(" " + rest):
            return [self._joined(self.pattern.findall(text))] if text else []
        return [self._joined(self.pattern.findall(first)), *map(self.__getitem__, rest.split(" "))]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text."""
        return np.frombuffer(b"".join([ids for ids, _ in self._pieces(text or "")]), "<u4")

    def encode_with_text(self, text: str | None) -> tuple[np.ndarray, str]:
        """Ids of a text, and the same as decimal numbers joined by commas."""
        pieces = self._pieces(text or "")
        return np.frombuffer(b"".join([ids for ids, _ in pieces]), "<u4"), ",".join([shown for _, shown in pieces])

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Bytes of all ids."""
        table = self.vocabulary.offsets
        ids = np.asarray(ids, np.int64)
        begin = table[ids]
        sizes = table[ids + 1] - begin
        before = np.cumsum(sizes) - sizes
        return self.vocabulary.blob[np.repeat(begin - before, sizes) + np.arange(int(sizes.sum()))].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The encoder of a vocabulary file (a name of the public tokenizers, or a path), one per process."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
    return _ENCODERS[vocabulary]


def encode_texts(docs: DataFrame, text_column: str = "text", ids_column: str = "token_ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """The documents with one more column, the ids of their texts."""
    docs = others(docs, ids_column)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids_column, T.ArrayType(T.IntegerType()))])
    names = [*docs.columns, ids_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary)
        for batch in batches:
            ids = [tool.encode(text).astype(np.int32) for text in batch.column(text_column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names)

    return docs.mapInArrow(run, schema)


def decode_ids(docs: DataFrame, ids_column: str = "token_ids", text_column: str = "decoded", vocabulary: str = VOCABULARY) -> DataFrame:
    """The rows with one more column, the text of their ids."""
    docs = others(docs, text_column)
    schema = T.StructType([*docs.schema.fields, T.StructField(text_column, T.StringType())])
    names = [*docs.columns, text_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary)
        for batch in batches:
            texts = [tool.decode(np.array(ids or [], np.int64)) for ids in batch.column(ids_column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    return docs.mapInArrow(run, schema)


def encode_checked(docs: DataFrame, text_column: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The documents with n_tokens, token_ids, and round_trip: whether the ids decode to the text; in one pass."""
    docs = others(docs, "n_tokens", "token_ids", "round_trip")
    added = [("n_tokens", T.LongType()), ("token_ids", T.ArrayType(T.IntegerType())), ("round_trip", T.BooleanType())]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(name, kind) for name, kind in added]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary)
        tool.kept = STEP_CHUNKS_KEPT
        try:
            for batch in batches:
                texts = batch.column(text_column).to_pylist()
                ids = [tool.encode(text) for text in texts]
                columns = [
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                    pa.array([tool.decode(x) == (text or "") for x, text in zip(ids, texts, strict=True)], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema.names)
        finally:
            tool.forget()
            tool.kept = CHUNKS_KEPT

    return docs.mapInArrow(run, schema)


def round_trip_report(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary)
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            for text in batch.column("text").to_pylist():
                ids, shown = tool.encode_with_text(text)
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(shown.encode()).hexdigest())
                text_digests.append(hashlib.sha256(tool.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    chosen = docs.select("doc_id", "text")
    schema = T.StructType([chosen.schema["doc_id"], *T._parse_datatype_string("n_tokens long, ids_sha256 string, decoded_sha256 string").fields])
    return chosen.mapInArrow(run, schema)
