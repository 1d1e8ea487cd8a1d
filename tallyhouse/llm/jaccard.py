"""Exact n-gram Jaccard join with PartEnum signatures.

A text's features are its distinct word shingles. Sets whose Jaccard similarity reaches the threshold have sizes in
the same band or in adjacent ones, and there differ in at most k features. For each band the feature domain is cut by
a hash into more than k partitions, so similar sets agree on at least one of them; for small k, subsets of partitions
are enumerated and similar sets agree on all partitions of one subset. A signature is a hash of the features in a
partition (or subset), with its band. A set takes part in its own band and, as the larger partner, in the one below.
Agreement on empty partitions alone is excluded by spare partitions; a set with too many empty ones emits those too.

Candidates are rows that share a signature. They are never expanded into all pairs: each is compared with the member
of its signature that shares most signatures with others, first once per document, then wherever the components still
differ. Signatures whose documents remain in several components are then compared across components, so no link is
lost; of signatures with equal members one is taken, and the join itself applies the bounds of sizes and odd sketches and
leaves a pair to the first signature that both documents list, so likely pairs leave it about once. Sets of more features than
a sketch has bits are then told apart by their counts per hash bucket, another exact bound. Every candidate pair is checked on its whole sets. Equal sets are grouped by a 128-bit hash and only meet through one of them per block.

Defined cases: null texts and texts without words have no features and link with nothing; fewer words than the shingle
length are one shingle; a null doc_id has no component but itself (null); rows that repeat a doc_id are one node, linked
if any of them is; equal sizes and ids need no tie rule, as components are minima. ``keep_first`` compares rows: where ids
are null or repeat, rows are numbered by id (null last), then by a hash of the row, and one row of each group stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.bytes import LOWER, blocks, byte_table, mixed, prefix_hashes, substring_hashes, text_bytes, words
from tallyhouse.llm.components import components, joined_components
from tallyhouse.llm.session import stored, unused

SHINGLE_WORDS = 5
PERCENT = 80
SPARE = 0.15  # spare partitions, as a share of k
# Partitions for a small k, of which every subset without k partitions gives a signature.
SMALL_K = {0: 1, 1: 3, 2: 5, 3: 6}

IS_WORD = ~byte_table(" \t\n\v\f\r", wide=False)

SKETCH_WORDS = 8  # 64-bit words of an odd sketch
SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]
COUNT_BUCKETS = 512  # of the counts that sets beyond the reach of the sketch have besides
FILTER_BITS = 1 << 24  # bits of the mask of ids that keeps other texts out of a shuffle: 4 MB at most
LISTED = 16  # first open signatures that each document lists, so that a pair is not joined at all of those it shares

# Texts of a vectorised step; shingles take some hundred times the bytes of their text for a moment.
SHINGLE_BLOCK_BYTES = 512 << 10

_U64 = np.uint64
_STEP = _U64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of all distinct shingles of a block, by row, then hash."""
    lowered = LOWER[data]
    starts, stops = words(lowered, offsets, IS_WORD)
    hashes = mixed(substring_hashes(prefix_hashes(lowered), starts, stops))
    bounds = np.searchsorted(starts, offsets)
    counts = np.diff(bounds)
    n = len(offsets) - 1
    per_row = np.where(counts >= length, counts - length + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(n), per_row)
    at = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row) + bounds[:-1][row]
    value = np.zeros(len(row), _U64)
    for step in range(length):
        within = at + step < bounds[1:][row]
        value = np.where(within, mixed(value * _STEP + hashes[np.minimum(at + step, max(len(hashes) - 1, 0))] + _U64(1)), value)
    order = np.argsort(value, kind="stable")
    small = row[order].astype(np.uint16) if n < 1 << 16 else row[order]
    order = order[np.argsort(small, kind="stable")]
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


class Bands:
    """Size bands of a threshold, with the largest difference and the number of partitions of each."""

    def __init__(self, percent: int, most: int):
        low, lows = 1, []
        while low <= most:
            lows.append(low)
            low = 100 * low // percent + 1
        self.low = np.array([*lows, low], np.int64)
        high = self.low[1:] - 1
        self.differ = high * (100 - percent) // percent
        spare = np.ceil(self.differ * SPARE).astype(np.int64)
        self.parts = np.array([SMALL_K.get(int(k), int(k + 1 + s)) for k, s in zip(self.differ, spare, strict=True)], np.int64)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, side="right") - 1


_BANDS: dict[int, Bands] = {}


def bands(percent: int, most: int) -> Bands:
    """Bands up to a size, kept per threshold."""
    if percent not in _BANDS or _BANDS[percent].low[-1] <= most:
        _BANDS[percent] = Bands(percent, max(most, 1 << 16) * 2)
    return _BANDS[percent]


def _band_signatures(row: np.ndarray, value: np.ndarray, band: np.ndarray, table: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Owner and signature of all sets in one band each; ``row`` numbers the sets from 0 without gaps."""
    n = len(band)
    differ, parts = table.differ[band], table.parts[band]
    first = np.concatenate([[0], np.cumsum(parts)])
    scattered = mixed(value, 1)
    part = ((scattered >> _U64(32)) * parts[row].astype(_U64) >> _U64(32)).astype(np.int64)
    key = first[:-1][row] + part
    sums = np.zeros(first[-1], _U64)
    np.add.at(sums, key, mixed(value, 2))
    filled = np.bincount(key, minlength=first[-1])
    owner = np.repeat(np.arange(n), parts)
    number = np.arange(first[-1]) - first[:-1][owner]
    empty = np.bincount(owner, filled == 0, minlength=n)
    needs_empty = empty >= parts - differ
    large = differ > max(SMALL_K)
    chosen = large[owner] & ((filled > 0) | needs_empty[owner])
    label = mixed((band[owner].astype(_U64) << _U64(32)) + number.astype(_U64), 3)
    owners, found = [owner[chosen]], [mixed(sums[chosen] ^ label[chosen], 4)]
    for k, m in SMALL_K.items():
        sets = np.flatnonzero(differ == k)
        if not len(sets):
            continue
        own = sums[first[:-1][sets][:, None] + np.arange(m)]
        for number_, subset in enumerate(combinations(range(m), m - k)):
            label = mixed((band[sets].astype(_U64) << _U64(32)) + _U64(number_), 5)
            owners.append(sets)
            found.append(mixed(own[:, list(subset)].sum(1, dtype=_U64) ^ label, 6))
    return np.concatenate(owners), np.concatenate(found)


def set_digests(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two hashes of each row's set."""
    first, second = np.zeros(n, _U64), np.zeros(n, _U64)
    np.add.at(first, row, mixed(value, 7))
    np.add.at(second, row, mixed(value, 8))
    return np.bincount(row, minlength=n), mixed(first), mixed(second)


def odd_sketches(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Per row, one bit for each hash bucket that holds an odd number of features, as 64-bit words.

    Every feature that only one of two sets has flips one bit, so two sketches differ in at most as many bits as the
    sets differ in features.
    """
    bits = 64 * SKETCH_WORDS
    bucket = (mixed(value, 9) % _U64(bits)).astype(np.int64)
    odd = np.bincount(row * bits + bucket, minlength=n * bits).reshape(n, bits) & 1
    return np.packbits(odd.astype(np.uint8), 1).view(np.int64).reshape(n, SKETCH_WORDS)


def bucket_counts(row: np.ndarray, value: np.ndarray, n: int) -> list[bytes | None]:
    """Per row of more features than a sketch has bits, the features of each hash bucket, up to 255; else nothing.

    Each feature that only one of two sets has changes one count by one, so the counts of two sets differ by no more in
    sum than the sets do; stopping at 255 only lowers that sum.
    """
    large = np.bincount(row, minlength=n) > 64 * SKETCH_WORDS
    number = np.cumsum(large) - 1
    inside = large[row]
    bucket = (mixed(value[inside], 10) % _U64(COUNT_BUCKETS)).astype(np.int64)
    size = int(large.sum()) * COUNT_BUCKETS
    counts = np.minimum(np.bincount(number[row[inside]] * COUNT_BUCKETS + bucket, minlength=size), 255).astype(np.uint8).reshape(-1, COUNT_BUCKETS)
    return [counts[number[i]].tobytes() if large[i] else None for i in range(n)]


def counts_allow(left: pa.Array, right: pa.Array, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether the counts of two sets allow them to reach the threshold, by the sum of their sizes; true without counts."""
    known = np.flatnonzero(left.is_valid().to_numpy(zero_copy_only=False) & right.is_valid().to_numpy(zero_copy_only=False))
    allowed = np.ones(len(left), bool)
    for some in np.array_split(known, len(known) // 4096 + 1):
        one, two = (text_bytes(side.take(pa.array(some)))[0].reshape(-1, COUNT_BUCKETS).astype(np.int64) for side in (left, right))
        allowed[some] = (100 + percent) * np.abs(one - two).sum(1) <= (100 - percent) * sizes[some]
    return allowed


def signatures(row: np.ndarray, value: np.ndarray, n: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and signature of all sets of a block; of equal sets only the first emits any."""
    size, one, two = set_digests(row, value, n)
    _, keep = np.unique(np.stack([size.astype(_U64), one, two], 1), axis=0, return_index=True)
    chosen = np.zeros(n, bool)
    chosen[keep] = True
    chosen &= size > 0
    if not chosen.any():
        return np.empty(0, np.int64), np.empty(0, _U64)
    table = bands(percent, int(size.max()))
    own = table.of(np.maximum(size, 1))
    smallest = -(-percent * size // 100)
    below = chosen & (own > 0) & (smallest < table.low[own])
    owners, found = [], []
    for mask, band in ((chosen, own), (below, own - 1)):
        sets = np.flatnonzero(mask)
        if len(sets):
            renumber = np.cumsum(mask) - 1
            inside = mask[row]
            owner, signature = _band_signatures(renumber[row[inside]], value[inside], band[sets], table)
            owners.append(sets[owner])
            found.append(signature)
    return np.concatenate(owners), np.concatenate(found)


def _described(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, n_shingles, the set's two hashes, its odd sketch and, if it is large, its counts, for every row."""
    names = ["doc_id", "n_shingles", "one", "two", *SKETCH]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in blocks(batch, "text", SHINGLE_BLOCK_BYTES):
                row, value = shingles(data, offsets, length)
                size, one, two = set_digests(row, value, part.num_rows)
                sketch = odd_sketches(row, value, part.num_rows)
                columns = [size, one.view(np.int64), two.view(np.int64), *sketch.T]
                counts = pa.array(bucket_counts(row, value, part.num_rows), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns], counts], [*names, "counts"])

    return docs.mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", counts binary")


def _candidates(docs: DataFrame, length: int, percent: int) -> DataFrame:
    """sig, doc: documents that share a signature with others."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in blocks(batch, "text", SHINGLE_BLOCK_BYTES):
                owner, signature = signatures(*shingles(data, offsets, length), part.num_rows, percent)
                ids = part.column("doc_id").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(signature.view(np.int64)), pa.array(ids[owner], pa.int64())], ["sig", "doc"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by sig and doc, those whose sig has more rows; the last one waits for the next batch."""
        sig, doc, open_ = np.empty(0, np.int64), np.empty(0, np.int64), False
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.concatenate([sig, batch.column(0).to_numpy()])
            doc = np.concatenate([doc, batch.column(1).to_numpy()])
            equal = sig[1:] == sig[:-1]
            keep = np.zeros(len(sig), bool)
            keep[1:] = equal
            keep[:-1] |= equal
            keep[0] |= open_
            take = np.flatnonzero(keep[:-1])
            if len(take):
                yield pa.RecordBatch.from_arrays([pa.array(sig[take]), pa.array(doc[take])], ["sig", "doc"])
            open_ = bool(keep[-1])
            sig, doc = sig[-1:], doc[-1:]
        if open_:
            yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(doc)], ["sig", "doc"])

    rows = docs.where("doc_id IS NOT NULL").mapInArrow(emit, "sig long, doc long")
    sorted_ = rows.repartition("sig").sortWithinPartitions("sig", "doc")
    return sorted_.mapInArrow(shared, "sig long, doc long")


def _with_centers(shared: DataFrame) -> DataFrame:
    """sig, doc, center: the member of each signature that shares most with all others, in sum over its signatures.

    The original of a group of near copies shares more with each copy than two copies do with each other, so it is the
    one to compare them with.
    """
    sizes = shared.groupBy("sig").agg(F.count("*").alias("n"))
    weights = shared.join(sizes, "sig").groupBy("doc").agg(F.sum("n").alias("weight"))
    centers = shared.join(weights, "doc").groupBy("sig").agg(F.max(F.struct("weight", (-F.col("doc")).alias("minus"))).alias("most"))
    return shared.join(centers.select("sig", (-F.col("most.minus")).alias("center")), "sig")


def similar(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], n: int, percent: int) -> np.ndarray:
    """Whether the sets of each row reach the threshold, from (row, hash) arrays of both sides."""
    row = np.concatenate([left[0], right[0]])
    value = np.concatenate([left[1], right[1]])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    equal = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
    both = np.bincount(row[1:][equal], minlength=n)
    union = np.bincount(row, minlength=n) - both
    return (union > 0) & (100 * both >= percent * union)


def _used(pairs: DataFrame) -> DataFrame:
    """Ids of the documents in pairs (a, b)."""
    return pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents of the given distinct ids. A mask with a bit per hash of an id keeps most other texts out of the shuffle."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    bit = F.expr("shiftleft(1L, CAST(_slot % 64 AS INT))")
    masks = ids.select(slot.alias("_slot")).groupBy(F.expr("_slot div 64").alias("_word")).agg(F.bit_or(bit).alias("_mask"))
    marked = docs.withColumn("_slot", slot).withColumn("_word", F.expr("_slot div 64")).join(F.broadcast(masks), "_word")
    near = marked.where("getbit(_mask, CAST(_slot % 64 AS INT)) = 1").select(*docs.columns)
    # These ids grow with the documents, so they are merged at every size rather than broadcast at small ones. The join is not
    # a semi join, as Spark would move that in front of the mask.
    return near.join(ids.hint("merge"), "doc_id").select(*docs.columns)


def _verified(pairs: DataFrame, texts: DataFrame, length: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in blocks(batch, "left", SHINGLE_BLOCK_BYTES):
                other = text_bytes(part.column("right"))
                hit = similar(shingles(data, offsets, length), shingles(*other, length), part.num_rows, percent)
                yield part.select(["a", "b"]).filter(pa.array(hit))

    joined = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left")), "a").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right")), "b")
    return joined.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _with_components(rows: DataFrame, labels: DataFrame, *columns: str) -> DataFrame:
    """The rows with the component of each named column (itself where it has no edge) as <column>_in."""
    for column in columns:
        named = labels.select(F.col("node").alias(column), F.col("component").alias("_found"))
        rows = rows.join(named, column, "left").withColumn(f"{column}_in", F.coalesce("_found", column)).drop("_found")
    return rows


def _can_link(left: str, right: str, percent: int):
    """Whether sizes and odd sketches allow two sets to reach the threshold; both are exact bounds."""
    a, b = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    apart = sum((F.bit_count(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))) for s in SKETCH), F.lit(0))
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & ((100 + percent) * apart <= (100 - percent) * (a + b))


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches allow."""
    left, right = sets.alias("l"), sets.alias("r")
    joined = pairs.join(left, F.col("a") == F.col("l.doc_id")).join(right, F.col("b") == F.col("r.doc_id"))
    return joined.where(_can_link("l", "r", percent)).select("a", "b").distinct()


def _different_signatures(placed: DataFrame) -> DataFrame:
    """sig of one signature for every set of members that is still in several components.

    Similar documents agree on many signatures, so the same members meet again and again; they are compared once. Member
    sets are told apart by their size and 128 bits of hashes.
    """
    members = F.when(F.col("doc") != F.col("center"), F.col("doc"))
    open_ = placed.groupBy("sig").agg(
        F.min("doc_in").alias("low"),
        F.max("doc_in").alias("high"),
        F.count(members).alias("n"),
        F.bit_xor(F.when(members.isNotNull(), F.xxhash64(members))).alias("one"),
        F.bit_xor(F.when(members.isNotNull(), F.xxhash64(members, F.lit(1)))).alias("two"),
    )
    return open_.where("low < high AND n > 1").groupBy("n", "one", "two").agg(F.min("sig").alias("sig")).select("sig")


def _pairs_across(open_: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of documents in different components that share an open signature and may link; few come twice.

    A pair is left to a smaller signature if both documents list it among their first ones. The smallest that they share
    has no such signature before it, so every pair is found, and the lists only save repeats of it.
    """
    first = open_.groupBy("doc").agg(F.slice(F.array_sort(F.collect_set("sig")), 1, LISTED).alias("listed"))
    described = first.join(sketched.withColumnRenamed("doc_id", "doc"), "doc")
    rows = open_.join(described, "doc")
    left, right = rows.alias("l"), rows.alias("r")
    earlier = F.array_min(F.array_intersect("l.listed", "r.listed")) < F.col("l.sig")
    met = (F.col("l.sig") == F.col("r.sig")) & (F.col("l.doc") < F.col("r.doc")) & (F.col("l.doc_in") != F.col("r.doc_in"))
    found = left.join(right, met & _can_link("l", "r", percent) & ~F.coalesce(earlier, F.lit(False)))
    return found.select(F.col("l.doc").alias("a"), F.col("r.doc").alias("b"))


def _counted(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (a, b) that the counts of large sets allow; all others stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            allowed = counts_allow(batch.column("left"), batch.column("right"), sizes, percent)
            yield batch.select(["a", "b"]).filter(pa.array(allowed))

    side = lambda name, counts: sets.select(F.col("doc_id").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("counts").alias(counts))
    joined = pairs.distinct().join(side("a", "left"), "a").join(side("b", "right"), "b")
    return joined.select("a", "b", "n_a", "n_b", "left", "right").mapInArrow(run, "a long, b long").distinct()


def links(docs: DataFrame, described: DataFrame, length: int, percent: int) -> DataFrame:
    """Component of every document that has a link: node, component."""
    sets = described.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["n_shingles", "one", "two"]
    copies = sets.join(sets.groupBy(*same).agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("last")).where("b < last").drop("last"), same).select(F.col("doc_id").alias("a"), "b")
    sketched = sets.select("doc_id", "n_shingles", *SKETCH)
    shared = stored(_with_centers(stored(_candidates(docs, length, percent), "signatures")), "candidates")
    pairs = shared.where("doc <> center").groupBy(F.col("doc").alias("a"), F.col("center").alias("b")).agg(F.count("*").alias("n"))
    pairs = stored(pairs.join(_possible(pairs.select("a", "b"), sketched, percent), ["a", "b"]), "pairs")
    texts = stored(_texts_of(docs, _used(pairs)), "texts")
    # The center that shares most signatures, once per document.
    first = pairs.groupBy("a").agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("b"))
    edges = stored(_verified(first, texts, length, percent).union(copies), "links")
    labels = stored(components(edges), "components")
    # Other centers, where the components differ.
    rest = _with_components(pairs.select("a", "b").join(first, ["a", "b"], "left_anti"), labels, "a", "b").where("a_in <> b_in").select("a", "b")
    labels = joined_components(labels, stored(_verified(rest, texts, length, percent), "links"))
    # Signatures whose documents are still apart: members other than the center, across components.
    placed = _with_components(shared, labels, "doc")
    apart = _different_signatures(placed)
    open_ = stored(placed.where("doc <> center").join(apart, "sig", "left_semi").select("sig", "doc", "doc_in"), "open")
    across = stored(_counted(_pairs_across(open_, sketched, percent), sets.select("doc_id", "n_shingles", "counts"), percent), "across")
    if across.isEmpty():
        return labels
    return joined_components(labels, stored(_verified(across, _texts_of(docs, _used(across)), length, percent), "links"))


def grouped(docs: DataFrame, length: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = stored(_described(chosen, length), "described")
    labels = links(chosen, described, length, percent)
    return described.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _numbered(docs: DataFrame, key: str) -> DataFrame:
    """The rows with a number that grows with the id; equal rows are parted by a tie number."""
    tie = unused(docs, "tie")
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.col(tie)]
    sorted_ = docs.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(sorted_.drop(tie).withColumn(key, F.monotonically_increasing_id()), "numbered")


def keep_first(docs: DataFrame, length: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without those that link to a document of smaller id, with their own columns."""
    columns, key = docs.columns, "doc_id"
    if not docs.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").isEmpty():
        key = unused(docs, "row_number")
        docs = _numbered(docs, key)
    found = grouped(docs.select(F.col(key).alias("doc_id"), "text"), length, percent).where("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(found, key, "left_anti").select(*columns)
