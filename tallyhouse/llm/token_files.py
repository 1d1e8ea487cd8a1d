"""Token-id files: one shared zstandard dictionary, one compressed frame per document, an offset index.

A file holds a run of documents in id order::

    magic | frame of document 0 | frame of document 1 | ... | index | index length | dictionary hash | magic

The index (an Arrow stream) has, per document, its id, the end of its frame and its number of ids, so a short document
is read by seeking to one frame. Ids are stored in the narrowest of 2 or 4 bytes that holds the vocabulary. Files lie in the shared folder;
their names are unique per task attempt, and the manifest (a table that Spark writes) lists those of the attempts
that succeeded, so lost executors and repeated tasks do no harm.

The dictionary is trained on the driver from ``SAMPLE_DOCS`` documents chosen by a hash of id and text; it only
affects the compression. Encoding keeps each distinct word of a worker (bounded by ``WORDS_KEPT``).

Defined cases: a null or empty text has the end id alone; null doc_ids come first; rows of equal doc_id are ordered by
a hash of their text; an empty table gives no files and no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm.session import stored
from tallyhouse.session import scratch_folder

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
SAMPLE_DOCS = 500
SAMPLE_BYTES = 32 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
WORDS_KEPT = 500_000
MAGIC = b"TOKIDS01"
TAIL = struct.Struct("<Q32s8s")
# ASCII characters that the tokenizer treats neither as letters, digits nor white space.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordEncoder(dict):
    """Ids of white-space separated chunks, packed; a chunk's ids do not depend on its neighbours."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.width = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.alphabet = {b: chr(256 + n) for n, b in enumerate(hidden)}

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        word = chunk.rstrip(PUNCTUATION)
        if word.isalpha() and max(word) < "Ā" and word == word.lower():
            if len(word) < len(chunk):
                got = self[word] + self[chunk[len(word) :]]
            else:  # one pre-token of letters: the model alone, on the characters that stand for its bytes
                got = self._packed([t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.alphabet))])
        else:
            got = self._packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        self[chunk] = got
        return got

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.width).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text without special tokens added."""
        text = text or ""
        # Lower-casing first joins more chunks; outside Latin-1, and where a special token may stand, the tokenizer does it.
        if "<|" not in text and (text.isascii() or max(text) < "Ā"):
            text = text.lower()
        return np.frombuffer(b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))), self.width)


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(vocabulary: str = VOCABULARY) -> WordEncoder:
    """The encoder of a vocabulary file (a name of the public tokenizers, or a path), one per process."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = WordEncoder(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
    return _ENCODERS[vocabulary]


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


INDEX = pa.schema([("doc_id", pa.int64()), ("end", pa.int64()), ("n_tokens", pa.int64())])


class FileWriter:
    """Writes the documents of one task to one file."""

    def __init__(self, folder: str, dictionary: bytes, width: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.ids"
        system, path = _open(self.uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.sink = system.open_output_stream(path)
        self.sink.write(MAGIC)
        self.width, self.at = width, len(MAGIC)
        self.hash = hashlib.sha256(dictionary).digest()
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, **_shared(dictionary))
        self.doc_ids: list[int | None] = []
        self.ends: list[int] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        frame = self.compressor.compress(ids.astype(self.width).tobytes())
        self.at += len(frame)
        self.doc_ids.append(doc_id)
        self.ends.append(self.at)
        self.counts.append(len(ids))
        self.sink.write(frame)

    def close(self) -> None:
        packed = pa.BufferOutputStream()
        schema = INDEX.with_metadata({"width": self.width})
        with pa.ipc.new_stream(packed, schema) as stream:
            stream.write_batch(pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (self.doc_ids, self.ends, self.counts)], schema=schema))
        index = packed.getvalue().to_pybytes()
        self.sink.write(index + TAIL.pack(len(index), self.hash, MAGIC))
        self.sink.close()


def _shared(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


class FileReader:
    """Random access to the documents of one file."""

    def __init__(self, uri: str, dictionary: bytes):
        system, path = _open(uri)
        self.source = system.open_input_file(path)
        size = self.source.size()
        length, digest, magic = TAIL.unpack(self.source.read_at(TAIL.size, size - TAIL.size))
        if magic != MAGIC or digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} is no token-id file of this dictionary")
        index = pa.ipc.open_stream(self.source.read_at(length, size - TAIL.size - length)).read_all()
        self.width = index.schema.metadata[b"width"].decode()
        self.doc_ids = index.column("doc_id").to_pylist()
        self.starts = np.concatenate([[len(MAGIC)], index.column("end").to_numpy()])
        self.counts = index.column("n_tokens").to_numpy()
        self.decompressor = zstandard.ZstdDecompressor(**_shared(dictionary))

    def __len__(self) -> int:
        return len(self.counts)

    def __getitem__(self, row: int) -> np.ndarray:
        begin, end = int(self.starts[row]), int(self.starts[row + 1])
        return self._ids(self.source.read_at(end - begin, begin), row)

    def _ids(self, frame: bytes, row: int) -> np.ndarray:
        size = int(self.counts[row]) * np.dtype(self.width).itemsize
        return np.frombuffer(self.decompressor.decompress(frame, max_output_size=size), self.width)

    def runs(self, most: int = 8 << 20) -> Iterable[tuple[int, list[np.ndarray]]]:
        """All documents in order, read in runs of about ``most`` bytes."""
        row = 0
        while row < len(self):
            stop = max(row + 1, int(np.searchsorted(self.starts, self.starts[row] + most)) - 1)
            stop = min(stop, len(self))
            base = int(self.starts[row])
            held = self.source.read_at(int(self.starts[stop]) - base, base)
            yield row, [self._ids(held[int(self.starts[i]) - base : int(self.starts[i + 1]) - base], i) for i in range(row, stop)]
            row = stop


def trained_dictionary(docs: DataFrame, vocabulary: str = VOCABULARY, sample_docs: int = SAMPLE_DOCS) -> bytes:
    """A dictionary from the serialized ids of ``sample_docs`` documents; empty if they are too few.

    The documents are those of the smallest hashes of id and text, so null or repeated ids make no difference. Of each,
    ``SAMPLE_BYTES`` of ids train the dictionary, so the driver gets at most the product of both.
    """
    hashed = docs.select("text", F.xxhash64("doc_id", "text").alias("digest"))
    smallest = [row["digest"] for row in hashed.select("digest").distinct().orderBy("digest").limit(sample_docs).collect()]
    # Equal rows are one sample, however many there are.
    chosen = hashed.where(F.col("digest") <= max(smallest, default=0)).groupBy("digest").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = word_encoder(vocabulary)
        for batch in batches:
            packed = [tool.encode(text).tobytes()[:SAMPLE_BYTES] for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], ["ids"])

    samples = [bytes(row["ids"]) for row in chosen.select("text").mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


MANIFEST = "path string, first_doc long, n_docs long, n_tokens long, dictionary_hash string"


def write_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> tuple[DataFrame, bytes]:
    """Token-id files of all documents in ascending doc_id order; the manifest (one row per file) and the dictionary."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = trained_dictionary(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, writer = word_encoder(vocabulary), None
        end = np.array([end_id], tool.width)
        for batch in batches:
            if writer is None and batch.num_rows:
                writer = FileWriter(folder, dictionary, tool.width)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                writer.add(doc_id, np.concatenate([tool.encode(text), end]))
        if writer is not None:
            writer.close()
            first = next((i for i in writer.doc_ids if i is not None), None)
            row = [[writer.uri], [first], [len(writer.counts)], [sum(writer.counts)], [writer.hash.hex()]]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["path", "first_doc", "n_docs", "n_tokens", "dictionary_hash"])

    ranged = docs.repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return stored(ranged.mapInArrow(run, MANIFEST), "token-manifest"), dictionary


def read_files(manifest: DataFrame, dictionary: bytes) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), ids."""
    return _read(manifest, dictionary, "doc_id long, start long, token_ids array<long>", lambda doc_ids, starts, ids: [pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))], ["doc_id", "start", "token_ids"])


def _read(manifest: DataFrame, dictionary: bytes, schema: str, columns, names: list[str]) -> DataFrame:
    before = Window.orderBy(F.col("first_doc").asc_nulls_first(), "path").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file: the window sees neither documents nor ids.
    placed = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("file_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("file_start").to_pylist(), strict=True):
                reader = FileReader(path, dictionary)
                starts = start + np.cumsum(reader.counts) - reader.counts
                for row, ids in reader.runs():
                    stop = row + len(ids)
                    yield pa.RecordBatch.from_arrays(columns(reader.doc_ids[row:stop], starts[row:stop], ids), names)

    # A task per file: the rows are tiny, so their bytes say nothing about the work behind them.
    return placed.repartition(max(1, manifest.count())).mapInArrow(run, schema)


def token_file_report(docs: DataFrame) -> DataFrame:
    """Per document, from files written and read back: start, number of ids, and crc32 of the ids in 4 bytes each."""
    manifest, dictionary = write_files(docs, scratch_folder(docs.sparkSession, "token-files"))

    def columns(doc_ids: list, starts: np.ndarray, ids: list[np.ndarray]) -> list[pa.Array]:
        sums = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
        return [pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array(sums, pa.int64())]

    return _read(manifest, dictionary, "doc_id long, start long, n_tokens long, ids_crc32 long", columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
