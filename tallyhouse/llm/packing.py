"""Cost-balanced packing of documents into training sequences.

A document of l tokens costs about ``l + QUADRATIC * l ** 2``: the linear layers and the attention. Every full run of
``CAPACITY`` tokens of a long document is a sequence of its own. What is left of each document (fewer tokens than a
sequence holds) is dealt by a hash of its row into groups of about ``GROUP_TOKENS`` tokens, one task each. A group
assigns its documents, longest first, to the sequence of lowest cost among those that still have room for the whole
document; where none has, the document is cut at the largest room left and the rest goes back in line.

The sequences of a group have room for exactly its tokens: full ones, and for the remainder one sequence for every
power of two in it, which needs no padding. So no token of padding is added at all.

The encoded remainders are stored once in the shared folder, and travel with their rows into the groups, so that every
piece is cut from its ids there. Equal runs give equal results: the stored rows are numbered, and ties go by these
numbers.

Defined cases: a null or empty text is the end id alone; null and repeated doc_ids are rows of their own; an empty table
gives no pieces. Columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.chunks import BYTE_VOCABULARY, byte_chunks
from tallyhouse.llm.session import prepare, stored

CAPACITY = 2048
END_ID = 1
# Tokens at which attention costs as much as the linear layers: six times a model width of 1,024.
QUADRATIC = 1 / 6144
GROUP_TOKENS = 1 << 20
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
NAMES = [part.split()[0] for part in PIECES.split(", ")]


def cost(tokens: int) -> float:
    """Estimated cost of attending to and passing a run of tokens."""
    return tokens + QUADRATIC * tokens * tokens


def checksum(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def sequence_room(tokens: int, capacity: int = CAPACITY) -> np.ndarray:
    """Room of the sequences that hold exactly so many tokens: full ones, then the powers of two of the remainder."""
    rest = tokens % capacity
    powers = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    return np.array([capacity] * (tokens // capacity) + powers, np.int64)


def assign(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents given by their lengths."""
    room = sequence_room(sum(lengths), capacity)
    left, spent = room.copy(), np.zeros(len(room))
    line = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(line)
    pieces = []
    while line:
        negative, document, start = heapq.heappop(line)
        length = -negative
        fits = left >= length
        if not fits.any():
            most = left.max()
            fits = left == most
            heapq.heappush(line, (int(most) - length, document, start + int(most)))
            length = int(most)
        sequence = int(np.where(fits, spent, np.inf).argmin())
        pieces.append((document, start, length, sequence, int(room[sequence] - left[sequence])))
        left[sequence] -= length
        spent[sequence] += cost(length)
    return pieces


def encoded(docs: DataFrame, vocabulary: str = BYTE_VOCABULARY, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Per document: its tokens, checksums of its full runs, and the packed ids of the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = byte_chunks(vocabulary)
        end = np.array([end_id], tool.width)
        for batch in batches:
            counts, sums, tails = [], [], []
            for text in batch.column("text").to_pylist():
                ids = np.concatenate([tool.encode(text), end])
                full = len(ids) // capacity * capacity
                counts.append(len(ids))
                sums.append([checksum(ids[i : i + capacity]) for i in range(0, full, capacity)])
                tails.append(ids[full:].tobytes())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums, pa.list_(pa.int64())), pa.array(tails, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_tokens", "full_sums", "tail"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, doc_tokens long, full_sums array<long>, tail binary")


def packed(docs: DataFrame, vocabulary: str = BYTE_VOCABULARY, end_id: int = END_ID, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Every piece of every document with its sequence and offset there.

    Sequences of full runs have odd numbers, the others even ones.
    """
    prepare(docs.sparkSession)
    rows = stored(encoded(docs, vocabulary, end_id, capacity), "packing-ids")
    rest = rows.agg(F.sum(F.expr(f"doc_tokens % {capacity}"))).first()[0] or 0
    groups = max(1, round(rest / group_tokens))
    full = rows.select("doc_id", "doc_tokens", F.posexplode("full_sums").alias("run", "ids_crc32")).select(
        "doc_id",
        (F.col("run").cast("long") * capacity).alias("start"),
        F.lit(capacity).cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(cost(capacity)).alias("cost"),
    )

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        width = byte_chunks(vocabulary).width
        table = table.sort_by("row")
        doc_ids, totals = table.column("doc_id").to_pylist(), table.column("doc_tokens").to_pylist()
        tails = [np.frombuffer(tail, width) for tail in table.column("tail").to_pylist()]
        found = []
        for document, start, length, sequence, offset in assign([len(tail) for tail in tails], capacity):
            before = totals[document] - len(tails[document])
            ids = tails[document][start : start + length]
            found.append((doc_ids[document], before + start, length, checksum(ids), totals[document], 2 * (sequence * groups + group), offset, cost(length)))
        columns = list(zip(*found, strict=True)) if found else [[] for _ in NAMES]
        kinds = [pa.int64()] * 7 + [pa.float64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=NAMES)

    numbered = rows.where("length(tail) > 0").select("doc_id", "doc_tokens", "tail", F.monotonically_increasing_id().alias("row"))
    dealt = numbered.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    return full.unionByName(dealt.groupBy("group").applyInArrow(pack, PIECES))
