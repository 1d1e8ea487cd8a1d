"""Removal of byte strings of ``SPAN`` bytes that occur more than once, by a sharded, hash-compared suffix sort.

Shards. Of each SPAN-byte window, the ``GRAM``-byte substring with the smallest hash is its anchor (the leftmost of
equal ones). Equal windows have equal anchors at equal offsets, so suffixes only need to meet within an anchor's group.
Neighbouring windows with one anchor form a block. A group with one block holds no repeat; blocks whose whole bytes
repeat are repeated throughout; both are settled by counting hashes. Only the other ("open") blocks of a group, with
one example of each repeated block, are fetched as bytes and sorted.

Suffix sort. The suffixes to the right of the anchor, and the prefixes to its left read backwards, are merge-sorted
(Python's stable merge sort). A comparison finds the common extension by binary search over prefix polynomial hashes
and confirms it on the bytes, so it takes a logarithmic number of steps and no collision passes. The extensions of
neighbours in both orders give, for every offset, the classes of equal windows.

Groups of more than ``HOT_BLOCKS`` different blocks are split instead: into cells of ``CELL`` offsets, then single
windows, keyed by the hash of the bytes that all windows of a cell share; counting those settles them without
gathering the group.

Defined cases: null texts are empty; texts shorter than SPAN have no windows; rows are identified by doc_id and a hash
of the text, and repeated rows count as separate texts; overlapping repeats within one text count; other columns
pass, but those named like the added one or in INTERNAL are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.bytes import blocks, cached_powers, mixed, prefix_hashes, substring_hashes, text_bytes
from tallyhouse.llm.session import others, stored

SPAN = 400
GRAM = 200
REACH = SPAN - GRAM + 1  # anchor positions per window
HOT_BLOCKS = 512
CELL = 16
PIECE = 8 << 20  # windows searched at a time; must stay below 2^24
# Texts of a vectorised step; its arrays take some hundred times the bytes of their text for a moment.
ANCHOR_BLOCK_BYTES = 512 << 10

_U64 = np.uint64
_PLACE = _U64((1 << 24) - 1)
KEY = ("_id", "_hash")
INTERNAL = (*KEY, "_spans", "_blocks", "_more")


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every run of ``width``, from running minima of fixed rows in both directions."""
    n = len(values)
    rows = np.concatenate([values, np.full(-n % width, ~_U64(0))]).reshape(-1, width)
    forward = np.minimum.accumulate(rows, 1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def anchored(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Blocks of a piece of texts: row, first and last window, anchor (relative to the text), and two hashes."""
    n = len(data)
    if n < SPAN:
        none = np.empty(0, np.int64)
        return none, none, none, none, none.view(_U64), none.view(_U64)
    prefix = prefix_hashes(data)
    at = np.arange(n - GRAM + 1)
    grams = mixed(substring_hashes(prefix, at, at + GRAM))
    least = _minima((grams & ~_PLACE) | at.astype(_U64), REACH)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    whole = np.flatnonzero(np.arange(len(least)) + SPAN <= offsets[row + 1])
    anchor = (least[whole] & _PLACE).astype(np.int64)
    begins = np.ones(len(whole), bool)
    begins[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(whole) != 1)
    head = np.flatnonzero(begins)
    tail = np.append(head[1:], len(whole)) - 1 if len(head) else head
    first, last, anchor = whole[head], whole[tail], anchor[head]
    shape = ((anchor - first) << 16 | (last - first)).astype(_U64)
    full = mixed(substring_hashes(prefix, first, last + SPAN) ^ mixed(shape, 9))
    row = row[first]
    base = offsets[row]
    return row, first - base, last - base, anchor - base, grams[anchor], full


def text_blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of all texts; a text beyond PIECE bytes is searched in overlapping pieces."""
    if len(data) <= PIECE:
        yield anchored(data, offsets)
        return
    for row in range(len(offsets) - 1):
        text = data[offsets[row] : offsets[row + 1]]
        for begin in range(0, max(1, len(text) - SPAN + 1), PIECE):
            part = text[begin : begin + PIECE + SPAN - 1]
            _, first, last, anchor, gram, full = anchored(part, np.array([0, len(part)]))
            yield np.full(len(first), row), first + begin, last + begin, anchor + begin, gram, full


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with their identity: doc_id (null: 0) and a hash of the text."""
    return docs.withColumn(KEY[0], F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))).withColumn(KEY[1], F.xxhash64("doc_id", "text"))


BLOCK_NAMES = [*KEY, "gram", "full", "first", "last", "anchor"]


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in blocks(batch, "text", ANCHOR_BLOCK_BYTES):
            keys = [part.column(k).to_numpy() for k in KEY]
            for row, first, last, anchor, gram, full in text_blocks(data, offsets):
                columns = [keys[0][row], keys[1][row], gram.view(np.int64), full.view(np.int64), first, last, anchor]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], BLOCK_NAMES)


def _blocks(docs: DataFrame) -> DataFrame:
    """One row per block: identity, gram, full, first, last, anchor."""
    return docs.select(*KEY, "text").mapInArrow(_block_rows, ", ".join(f"{n} long" for n in BLOCK_NAMES))


class Side:
    """One direction from the anchor of a block: its bytes and their prefix polynomial hashes."""

    __slots__ = ("hashes", "text")

    def __init__(self, text: bytes):
        self.text = text
        self.hashes = prefix_hashes(np.frombuffer(text, np.uint8)).tolist()

    def extension(self, other: Side) -> int:
        """Length of the common extension: binary search on the hashes, confirmed on the bytes."""
        low, high = 0, min(len(self.text), len(other.text))
        while low < high:
            middle = (low + high + 1) // 2
            if self.hashes[middle] == other.hashes[middle]:
                low = middle
            else:
                high = middle - 1
        if self.text[:low] != other.text[:low]:  # hashes collided
            return next(i for i, (a, b) in enumerate(zip(self.text, other.text, strict=False)) if a != b)
        return low

    def compare(self, other: Side) -> int:
        common = self.extension(other)
        return (self.text[common : common + 1] > other.text[common : common + 1]) - (self.text[common : common + 1] < other.text[common : common + 1])


def _classes(sides: list[Side], lengths: np.ndarray) -> np.ndarray:
    """Per length and block, the class of blocks whose sides agree on that many bytes."""
    order = sorted(range(len(sides)), key=cmp_to_key(lambda i, j: sides[i].compare(sides[j])))
    common = np.array([sides[i].extension(sides[j]) for i, j in zip(order, order[1:], strict=False)], np.int64)
    out = np.zeros((len(lengths), len(sides)), np.int64)
    out[:, order[1:]] = np.cumsum(common[None, :] < lengths[:, None], 1)
    return out


def repeated_windows(texts: list[bytes], anchors: list[int]) -> list[list[tuple[int, int]]]:
    """Per block of a group, the runs of window starts (relative to the block) that another block has too.

    A block of n bytes holds the windows that start in its first n - SPAN + 1 bytes; ``anchors`` are positions in it.
    """
    right = [Side(t[a:]) for t, a in zip(texts, anchors, strict=True)]
    left = [Side(t[:a][::-1]) for t, a in zip(texts, anchors, strict=True)]
    offset = np.arange(REACH)
    far = np.array(anchors)
    near = far - np.array([len(t) - SPAN for t in texts])
    inside = (offset[:, None] >= near) & (offset[:, None] <= far)
    classes = _classes(right, SPAN - offset) * len(texts) + _classes(left, offset)
    classes = np.where(inside, classes, -1 - np.arange(len(texts)))
    order = np.argsort(classes, 1, kind="stable")
    ranked = np.take_along_axis(classes, order, 1)
    equal = ranked[:, 1:] == ranked[:, :-1]
    flags = np.zeros(ranked.shape, bool)
    flags[:, 1:] |= equal
    flags[:, :-1] |= equal
    hit = np.zeros(ranked.shape, bool)
    np.put_along_axis(hit, order, flags, 1)
    out = []
    for i in range(len(texts)):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[:, i], [0]])))
        out.append([(int(far[i] - b + 1), int(far[i] - a)) for a, b in edge.reshape(-1, 2).tolist()])
    return out


_SPANS = "_id long, _hash long, start long, stop long"


def _sorted_spans(cut: DataFrame) -> DataFrame:
    """Repeated spans of the open blocks of all groups that are not hot."""

    def settle(group: list[dict]) -> list[tuple[int, int, int, int]]:
        found = repeated_windows([r["bytes"] for r in group], [r["anchor"] - r["first"] for r in group])
        return [(r["_id"], r["_hash"], r["first"] + a, r["first"] + b + SPAN) for r, runs in zip(group, found, strict=True) if r["open"] for a, b in runs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        for batch in batches:
            spans = []
            for row in batch.to_pylist():
                if group and group[0]["gram"] != row["gram"]:
                    spans += settle(group)
                    group = []
                group.append(row)
            yield _span_batch(spans)
        yield _span_batch(settle(group) if group else [])

    return cut.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, _SPANS)


def _span_batch(spans: list[tuple]) -> pa.RecordBatch:
    table = np.array(spans, np.int64).reshape(-1, 4)
    return pa.RecordBatch.from_arrays([pa.array(table[:, i]) for i in range(4)], ["_id", "_hash", "start", "stop"])


def _bucket_rows(cut: DataFrame, width: int) -> DataFrame:
    """Cells of ``width`` offsets of hot blocks: the hash of what all their windows share, and that of all their bytes."""
    names = ["gram", "cell", "core", "whole", *KEY, "first", "anchor", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("bytes"))
            prefix = prefix_hashes(data)
            cached_powers(len(prefix))
            field = lambda name: batch.column(name).to_numpy()  # noqa: E731, B023
            first, anchor, low, high = field("first"), field("anchor"), field("low"), field("high")
            count = high // width - low // width + 1
            row = np.repeat(np.arange(batch.num_rows), count)
            cell = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + (low // width)[row]
            mid = (offsets[:-1] + anchor - first)[row]
            least, most = np.maximum(cell * width, low[row]), np.minimum(cell * width + width - 1, high[row])
            core = mixed(substring_hashes(prefix, mid - cell * width, mid + SPAN - (cell * width + width - 1)))
            whole = mixed(substring_hashes(prefix, mid - most, mid + SPAN - least) ^ mixed((least << 16 | most).astype(_U64), 9))
            columns = [field("gram")[row], cell, core.view(np.int64), whole.view(np.int64), field("_id")[row], field("_hash")[row], first[row], anchor[row], least, most]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return cut.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _split_spans(cut: DataFrame) -> DataFrame:
    """Repeated spans of the blocks of hot groups, by counting cells, then windows."""
    spans = None
    for width in (CELL, 1):
        rows = _bucket_rows(cut, width)
        cores = rows.groupBy("gram", "cell", "core").agg(F.count("*").alias("n")).where("n > 1")
        wholes = rows.groupBy("gram", "cell", "core", "whole").agg(F.count("*").alias("same"))
        told = stored(rows.join(cores, ["gram", "cell", "core"]).join(wholes, ["gram", "cell", "core", "whole"]), "cells")
        settled = told.where("same > 1").select(*KEY, (F.col("anchor") - F.col("high")).alias("start"), (F.col("anchor") - F.col("low") + SPAN).alias("stop"))
        spans = settled if spans is None else spans.union(settled)
        # Repeated cells stay in the next step as partners: an open cell may share windows with them.
        rest = told.join(told.groupBy("gram", "cell", "core").agg(F.min("same").alias("least")).where("least = 1"), ["gram", "cell", "core"], "left_semi")
        cut = cut.drop("low", "high").join(rest.select(*KEY, "first", "low", "high"), [*KEY, "first"])
    return spans


_BLOCK = "struct<gram:bigint,first:bigint,last:bigint,anchor:bigint,open:boolean,hot:boolean>"


def _settled(docs: DataFrame) -> DataFrame:
    """The keyed documents with spans of wholly repeated blocks and the blocks left to compare."""
    found = _blocks(docs)
    groups = found.groupBy("gram").agg(F.count("*").alias("n"), F.min("full").alias("lo"), F.max("full").alias("hi")).where("n > 1").drop("n")
    repeated = stored(found.join(groups, "gram"), "blocks")
    varied = repeated.where("lo <> hi")
    place = F.struct(*KEY, "first")
    same = varied.groupBy("gram", "full").agg(F.count("*").alias("same"), F.min(place).alias("example"))
    sizes = same.groupBy("gram").agg(F.count("*").alias("different"), F.min("same").alias("least"))
    told = varied.join(same, ["gram", "full"]).join(sizes, "gram")
    told = told.withColumn("open", F.col("same") == 1).withColumn("sent", (F.col("least") == 1) & (F.col("open") | (place == F.col("example"))))
    span = F.struct(F.col("first").alias("start"), (F.col("last") + SPAN).alias("stop"))
    block = F.struct("gram", "first", "last", "anchor", "open", (F.col("different") > HOT_BLOCKS).alias("hot"))
    rows = told.select(*KEY, F.when(~F.col("open"), span).alias("span"), F.when(F.col("sent"), block).alias("block")).union(
        repeated.where("lo = hi").select(*KEY, span.alias("span"), F.lit(None).cast(_BLOCK).alias("block"))
    )
    per_text = rows.groupBy(*KEY).agg(F.collect_set("span").alias("_spans"), F.collect_set("block").alias("_blocks"))
    return stored(docs.join(per_text, list(KEY), "left"), "settled")


def repeated_spans(docs: DataFrame, spans_column: str = "repeated_spans") -> DataFrame:
    """The documents with one more column, the bytes of their texts that repeats cover: disjoint ascending spans."""
    docs = others(docs, spans_column, *INTERNAL)
    columns = docs.columns
    known = _settled(_keyed(docs))
    waiting = F.size(F.coalesce("_blocks", F.array().cast(f"array<{_BLOCK}>"))) > 0
    todo = known.where(waiting)
    sent = todo.where("text IS NOT NULL").dropDuplicates(list(KEY)).select(*KEY, F.encode("text", "UTF-8").alias("_bytes"), F.explode("_blocks").alias("b"))
    cut = stored(
        sent.select(*KEY, "b.gram", "b.first", "b.anchor", "b.open", "b.hot", (F.col("b.anchor") - F.col("b.last")).alias("low"), (F.col("b.anchor") - F.col("b.first")).alias("high"), F.expr("substring(_bytes, CAST(b.first + 1 AS INT), CAST(b.last - b.first AS INT) + " + str(SPAN) + ")").alias("bytes")),
        "cut",
    )
    calm = cut.where("NOT hot").select(*KEY, "gram", "first", "anchor", "open", "bytes")
    hot = cut.where("hot").select(*KEY, "gram", "first", "anchor", "low", "high", "bytes")
    more = _sorted_spans(calm).union(_split_spans(hot)).groupBy(*KEY).agg(F.collect_set(F.struct("start", "stop")).alias("_more"))
    done = known.where(~waiting).select(*columns, F.coalesce("_spans", F.array().cast("array<struct<start:bigint,stop:bigint>>")).alias("_spans"), F.lit(None).cast("array<struct<start:bigint,stop:bigint>>").alias("_more"))
    rest = todo.join(more, list(KEY), "left").select(*columns, "_spans", "_more")
    return _merge(done.union(rest), columns, spans_column)


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _merge(rows: DataFrame, columns: list[str], spans_column: str) -> DataFrame:
    """Both kinds of spans of each row joined into disjoint ones."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    schema = T.StructType([*[rows.schema[c] for c in columns], T.StructField(spans_column, rows.schema["_spans"].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for own, more in zip(batch.column("_spans").to_pylist(), batch.column("_more").to_pylist(), strict=True):
                both = [(s["start"], s["stop"]) for s in [*(own or []), *(more or [])]]
                spans.append([{"start": a, "stop": b} for a, b in merged_spans(both)])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(spans, kind)], [*columns, spans_column])

    return rows.mapInArrow(run, schema)


def without_spans(text: bytes, spans: list[dict]) -> bytes:
    """The bytes outside the spans."""
    out, at = [], 0
    for span in spans:
        out.append(text[at : span["start"]])
        at = span["stop"]
    return b"".join([*out, text[at:]])


def removal_report(docs: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs, and a digest of the remaining bytes."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            spans = batch.column("repeated_spans").to_pylist()
            columns = [
                [len(t) for t in texts],
                [sum(s["stop"] - s["start"] for s in x) for x in spans],
                [len(x) for x in spans],
                [hashlib.sha256(without_spans(t, x)).hexdigest() for t, x in zip(texts, spans, strict=True)],
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], names)

    found = repeated_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return found.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
