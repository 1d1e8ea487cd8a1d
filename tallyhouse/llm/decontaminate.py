"""Benchmark decontamination with suffix arrays over the training words.

A shard is a block of training texts. Its suffix array holds the word positions whose first words also begin a test
suffix (no other position can match one), sorted by the following ``window`` words. Every test suffix is looked up in
every shard by binary search; the range found gives all its locations. The longest verbatim match of a document is the
longest run of words from a location that stands in one item, searched in a suffix array of the items; a match of a whole
short item counts as well. Shards stay where the input partitions are: nothing is shuffled.

Defined cases: a null or empty text has no words; test items without words never match; an item of fewer words than
the window is one window; rows that repeat an item_id are searched each and reported as one item, items of different
ids with the same text are each reported, as are repeated rows; ties do not matter, as all locations are kept.
Items are read by the driver in blocks of at most ``ITEM_BLOCK_BYTES``; more blocks mean more passes over the
documents, whose spans are then merged per row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.bytes import LOWER, blocks, byte_table, mixed, prefix_hashes, substring_hashes, text_bytes, words
from tallyhouse.llm.session import others, stored

WINDOW = 10
ITEM_BLOCK_BYTES = 16 << 20
LEAD_WORDS = 3  # words of a test suffix that a training position must share to enter a suffix array
LEAD_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)

IS_WORD = byte_table("abcdefghijklmnopqrstuvwxyz0123456789", wide=True)

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased word (never 0) and the number of words before each text's start and end."""
    lowered = LOWER[data]
    starts, stops = words(lowered, offsets, IS_WORD)
    hashes = mixed(substring_hashes(prefix_hashes(lowered), starts, stops)) | np.uint64(1)
    return hashes, np.searchsorted(starts, offsets)


def following(hashes: np.ndarray, ends: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """One row per position: the hashes of ``width`` words from there, 0 beyond the end of the text."""
    index = at[:, None] + np.arange(width)
    out = hashes[np.minimum(index, len(hashes) - 1)] if len(hashes) else np.zeros(index.shape, np.uint64)
    out[index >= ends[:, None]] = 0
    return out


def lead_key(hashes: np.ndarray, width: int) -> np.ndarray:
    """Bucket of the ``width`` words from each position (the last ones wrap, which later steps reject)."""
    key = hashes.copy()
    for step in range(1, width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + np.roll(hashes, -step)
    return (mixed(key) >> np.uint64(64 - LEAD_BITS)).astype(np.int64)


def _sums(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and sums of words times them before each position."""
    power = np.ones(len(hashes) + 1, np.uint64)
    power[1:] = np.cumprod(np.full(len(hashes), _BASE))
    return power, np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:-1], dtype=np.uint64)])


class ItemWords:
    """The words of items one after the other, a 0 behind each item, and the places of words in suffix order."""

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray):
        counts = np.diff(bounds)
        place = np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)
        self.words = np.zeros(len(hashes) + len(counts), np.uint64)
        self.words[place] = hashes
        self.ends = np.zeros(len(self.words), np.int64)
        self.ends[place] = np.repeat(np.cumsum(counts + 1) - 1, counts)
        self.power, self.sums = _sums(self.words)
        n, step, most = len(self.words), 1, int(counts.max(initial=0)) + 1
        rank = np.unique(self.words, return_inverse=True)[1].astype(np.int64)
        while step < most:
            beyond = np.zeros(n, np.int64)
            beyond[: max(n - step, 0)] = rank[step:] + 1
            rank = np.unique(rank * (n + 1) + beyond, return_inverse=True)[1].astype(np.int64)
            step *= 2
        self.order = place[np.argsort(rank[place], kind="stable")]

    def longest(self, hashes: np.ndarray, stops: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For positions of a text and the ends of their texts, the most words from there that stand in one item.

        A binary search by suffix; it visits both neighbours of the position, one of which has the most words in common.
        """
        power, sums = _sums(hashes)
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.order), np.int64)
        best = np.zeros(len(at), np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return best
            middle = (low[open_] + high[open_]) // 2
            mine, theirs = at[open_], self.order[middle]
            most = np.minimum(stops[open_] - mine, self.ends[theirs] - theirs)
            same, over = np.zeros(len(open_), np.int64), most + 1
            while (over - same > 1).any():
                size = (same + over) // 2
                equal = (sums[mine + size] - sums[mine]) * self.power[theirs] == (self.sums[theirs + size] - self.sums[theirs]) * power[mine]
                same, over = np.where(equal, size, same), np.where(equal, over, size)
            best[open_] = np.maximum(best[open_], same)
            next_ = np.where(mine + same < stops[open_], hashes[np.minimum(mine + same, len(hashes) - 1)], np.uint64(0))
            below = self.words[theirs + same] < next_
            low[open_] = np.where(below, middle + 1, low[open_])
            high[open_] = np.where(below, high[open_], middle)


@dataclass
class TestSuffixes:
    """Distinct test windows in suffix order, with the items that contain each."""

    rows: np.ndarray  # distinct windows x window, padded with 0
    lengths: np.ndarray
    item_start: np.ndarray  # per window, where its items begin in ``items``
    items: np.ndarray
    lead: int
    lead_table: np.ndarray
    words: ItemWords


def test_suffixes(item_ids: list, texts: list[str | None], window: int) -> TestSuffixes | None:
    """All test suffixes of a block of items, cut to the window; None if no item has words."""
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    hashes, bounds = word_hashes(data, offsets)
    counts = np.diff(bounds)
    per_item = np.where(counts >= window, counts - window + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(texts)), per_item)
    if not len(owner):
        return None
    at = bounds[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(per_item) - per_item, per_item)
    table = following(hashes, bounds[owner + 1], at, window)
    rows, inverse = np.unique(table, axis=0, return_inverse=True)
    pairs = np.unique(np.stack([inverse.ravel(), owner], 1), axis=0)
    lengths = (rows != 0).sum(1)
    lead = int(min(LEAD_WORDS, lengths.min()))
    lead_table = np.zeros(1 << LEAD_BITS, bool)
    padded = np.ascontiguousarray(rows[:, :lead])
    key = padded[:, 0].copy()
    for step in range(1, lead):
        key = key * np.uint64(0x9E3779B97F4A7C15) + padded[:, step]
    lead_table[(mixed(key) >> np.uint64(64 - LEAD_BITS)).astype(np.int64)] = True
    item_start = np.searchsorted(pairs[:, 0], np.arange(len(rows) + 1))
    return TestSuffixes(rows, lengths, item_start, pairs[:, 1], lead, lead_table, ItemWords(hashes, bounds))


def suffix_array(hashes: np.ndarray, bounds: np.ndarray, tests: TestSuffixes, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted training positions that share a test suffix's first words, and their words."""
    at = np.flatnonzero(tests.lead_table[lead_key(hashes, tests.lead)]) if len(hashes) else np.empty(0, np.int64)
    ends = bounds[np.searchsorted(bounds, at, side="right")] if len(at) else at
    rows = following(hashes, ends, at, window)
    order = np.lexsort(rows.T[::-1])
    return at[order], rows[order]


def search(rows: np.ndarray, tests: TestSuffixes, *, after: bool) -> np.ndarray:
    """For every test suffix, the first row not below it (``after``: above all rows that begin with it)."""
    low = np.zeros(len(tests.rows), np.int64)
    high = np.full(len(tests.rows), len(rows), np.int64)
    column = np.arange(tests.rows.shape[1])
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        mine, theirs = tests.rows[open_], rows[middle]
        differs = (mine != theirs) & (column < tests.lengths[open_, None])
        first = differs.argmax(1)
        line = np.arange(len(open_))
        equal = ~differs[line, first]
        below = np.where(equal, after, theirs[line, first] < mine[line, first])
        low[open_] = np.where(below, middle + 1, low[open_])
        high[open_] = np.where(below, high[open_], middle)


def shard_matches(data: np.ndarray, offsets: np.ndarray, tests: TestSuffixes, window: int) -> dict[str, list]:
    """Per text of a shard: word count, hit word spans, longest verbatim match in words, item numbers."""
    hashes, bounds = word_hashes(data, offsets)
    n = len(offsets) - 1
    out = {"n_words": np.diff(bounds), "spans": [[] for _ in range(n)], "longest": np.zeros(n, np.int64), "items": [[] for _ in range(n)]}
    at, rows = suffix_array(hashes, bounds, tests, window)
    if not len(at):
        return out
    low, high = search(rows, tests, after=False), search(rows, tests, after=True)
    found = high - low
    test = np.repeat(np.arange(len(found)), found)
    if not len(test):
        return out
    place = at[np.repeat(low - np.cumsum(found) + found, found) + np.arange(len(test))]
    length = tests.lengths[test]
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + length, -1)
    hit = np.cumsum(change[:-1]) > 0
    edge = np.zeros(len(hashes) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], hit[:-1]])
    after = np.concatenate([hit[1:], [False]])
    starts = np.flatnonzero(hit & (~before | edge[:-1]))
    stops = np.flatnonzero(hit & (~after | edge[1:])) + 1
    owner = np.searchsorted(bounds, starts, side="right") - 1
    for o, a, b in zip(owner.tolist(), (starts - bounds[owner]).tolist(), (stops - bounds[owner]).tolist(), strict=True):
        out["spans"][o].append((a, b))
    _longest(out["longest"], hashes, bounds, tests, test, place, window)
    many = tests.item_start[test + 1] - tests.item_start[test]
    line = np.repeat(np.arange(len(test)), many)
    item = tests.items[np.repeat(tests.item_start[test] - np.cumsum(many) + many, many) + np.arange(len(line))]
    text = (np.searchsorted(bounds, place, side="right") - 1)[line]
    for o, i in np.unique(np.stack([text, item], 1), axis=0).tolist():
        out["items"][o].append(i)
    return out


def _longest(longest: np.ndarray, hashes: np.ndarray, bounds: np.ndarray, tests: TestSuffixes, test: np.ndarray, place: np.ndarray, window: int) -> None:
    """Longest match of each text: a whole short item, or the words from a full window on that stand in one item."""
    owner = np.searchsorted(bounds, place, side="right") - 1
    np.maximum.at(longest, owner, tests.lengths[test])
    full = tests.lengths[test] == window
    np.maximum.at(longest, owner[full], tests.words.longest(hashes, bounds[owner[full] + 1], place[full]))


def _item_blocks(benchmark: DataFrame, item_column: str, text_column: str, most: int) -> Iterator[tuple[list, list]]:
    """Items in blocks of about ``most`` bytes; the size is read before anything is collected."""
    named = benchmark.select(F.col(item_column).alias("item"), F.col(text_column).alias("text")).where("text IS NOT NULL")
    size = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // most))
    for block in range(n):
        part = named if n == 1 else named.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == block)
        got = part.collect()
        yield [row["item"] for row in got], [row["text"] for row in got]


def _scan(docs: DataFrame, text_column: str, item_type: T.DataType, ids: list, tests: TestSuffixes | None, window: int, prefix: str) -> DataFrame:
    """All columns of the documents plus what one block of items matches."""
    keep = docs.columns
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField(f"{prefix}_words", T.LongType()),
            T.StructField(f"{prefix}_spans", T.ArrayType(SPAN)),
            T.StructField(f"{prefix}_longest", T.LongType()),
            T.StructField(f"{prefix}_items", T.ArrayType(item_type)),
        ]
    )
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    items_type = pa.list_(pa.int64()) if isinstance(item_type, T.LongType) else pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in blocks(batch, text_column):
                if tests is None:
                    none = [[] for _ in range(part.num_rows)]
                    got = {"n_words": np.diff(word_hashes(data, offsets)[1]), "spans": none, "longest": np.zeros(part.num_rows, np.int64), "items": none}
                else:
                    got = shard_matches(data, offsets, tests, window)
                spans = [[{"start": a, "stop": b} for a, b in x] for x in got["spans"]]
                items = [list(dict.fromkeys(ids[i] for i in x)) for x in got["items"]]
                columns = [part.column(c) for c in keep]
                columns += [pa.array(got["n_words"], pa.int64()), pa.array(spans, span_type), pa.array(got["longest"], pa.int64()), pa.array(items, items_type)]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *[f"{prefix}_{x}" for x in ("words", "spans", "longest", "items")]])

    return docs.mapInArrow(run, schema)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    item_block_bytes: int = ITEM_BLOCK_BYTES,
    prefix: str = "match",
) -> DataFrame:
    """The documents with ``match_words``, ``match_spans`` (word positions), ``match_longest``, ``match_items``.

    Other columns pass through; one with the name of an added one is replaced. With several item blocks, the rows are
    scanned once for each, and their spans and items are merged.
    """
    added = [f"{prefix}_{x}" for x in ("words", "spans", "longest", "items")]
    got = [f"_{x}" for x in added[1:]]
    docs = others(docs, *added, *got)
    kind = T.LongType() if isinstance(benchmark.schema[item_column].dataType, T.IntegralType) else T.StringType()
    benchmark = benchmark.withColumn(item_column, F.col(item_column).cast(kind))
    out = None
    for ids, texts in _item_blocks(benchmark, item_column, item_text, item_block_bytes):
        tests = test_suffixes(ids, texts, window)
        if out is None:
            out = _scan(docs, text_column, kind, ids, tests, window, prefix)
            continue
        # What the blocks before gave is written, so the driver and the plan hold one table at a time.
        held = stored(out, "item-block").select(*docs.columns, *[F.col(a).alias(g) for a, g in zip(added[1:], got, strict=True)])
        spans, longest, items = (F.col(x) for x in added[1:])
        out = _scan(held, text_column, kind, ids, tests, window, prefix).select(
            *docs.columns,
            added[0],
            merge_spans(F.concat(got[0], spans)).alias(added[1]),
            F.greatest(got[1], longest).alias(added[2]),
            F.array_distinct(F.concat(got[2], items)).alias(added[3]),
        )
    return out


def merge_spans(spans):
    """Overlapping or touching spans joined, as a column expression."""
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast(T.ArrayType(SPAN)),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["stop"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["stop"], x["stop"]).alias("stop"))),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )


def span_words(spans):
    """Number of words in disjoint spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, x: total + x["stop"] - x["start"])


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents in which no test window occurs, with their own columns."""
    prefix = "match"
    while any(c.lower().lstrip("_").startswith(f"{prefix}_") for c in docs.columns):
        prefix += "x"
    return matches(docs, benchmark, text_column, window=window, prefix=prefix).where(F.size(f"{prefix}_spans") == 0).select(*docs.columns)


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, hit words, items with occurring windows and a digest of them."""
    found = matches(docs.select("doc_id", "text"), benchmark)
    names = F.array_sort(F.transform("match_items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        F.col("match_words").alias("n_words"),
        span_words(F.col("match_spans")).alias("n_hit"),
        F.size("match_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("match_spans") > 0).alias("contaminated"),
        F.col("match_longest").alias("longest_match"),
    )
