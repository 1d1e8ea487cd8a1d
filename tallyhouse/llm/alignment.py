"""Alignment of two tokenizers over the same bytes, as an Arrow pipeline whose counts Spark merges.

A text is encoded by a byte-level vocabulary (A) and a sentence-piece vocabulary (B); both spell a space and the text. A
block of documents is worked on as flat arrays: lists are flattened with their parent indices, token ends are cumulative
sums of token bytes less those of the documents before, and an outer hash join of the two sides on (document, end) keys
gives the cells of the alignment. A cell belongs to the token of either side that covers it, which is the next one that
ends at or after it, so each cell is one link of an A and a B token; cells where both sides end close a group.

Counts: a block counts its links per pair of ids (``Table.group_by``), Spark merges these partial counts into
corpus-wide ones and returns each block the counts of its own pairs, where the sums per document are taken. What is
shuffled are distinct pairs per block and, once, the distinct pairs of each document as codes of its block's pairs; links
never are. No pair, however frequent, has more rows than there are blocks.

Defined cases: null, empty texts, and texts that B cannot spell (it joins U+2581 with the space, for one) have no
tokens: all numbers are 0 and the digest is the empty string; null and repeated doc_ids are rows of their own; an
empty table gives an empty result. Columns beside doc_id and text are ignored. A block holds about ``BLOCK_BYTES`` of
text, or one longer text.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.chunks import BYTE_VOCABULARY, PIECE_VOCABULARY, byte_chunks, piece_chunks
from tallyhouse.llm.session import prepare, stored

BLOCK_BYTES = 512 << 10
END_BITS = 40
B_BITS = 32
PER_DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ALIGNED = f"block string, {PER_DOCUMENT}, codes array<int>, counts array<long>, pairs array<long>"
REPORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
    values = np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _ends(lists: pa.ListArray, lengths: pa.Array) -> pa.Table:
    """Per token: its place in the flat array, its id, and the key of its document and end."""
    ids, parents = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
    total = pc.cumulative_sum(pc.take(lengths, ids))
    # Bytes of all documents before: the total at the last token before each document's first one.
    before = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), total]), lists.offsets.cast(pa.int64()).slice(0, len(lists)))
    ends = pc.subtract(total, pc.take(before, parents))
    key = pc.add(pc.shift_left(parents, pa.scalar(END_BITS, pa.int64())), ends)
    return pa.table({"key": key, "place": pa.array(np.arange(len(ids))), "id": ids})


def _cells(a: pa.Table, b: pa.Table) -> pa.Table:
    """Cells in text order: key, and place and id of the token of either side that ends there (null: it goes on)."""
    left = a.rename_columns(["key", "a_place", "a_id"])
    right = b.rename_columns(["key", "b_place", "b_id"])
    cells = left.join(right, "key", join_type="full outer", use_threads=False)
    return cells.take(pc.sort_indices(cells.column("key")))


def _digests(cells: pa.Table, documents: int, names: pa.Array, b_first: int) -> list[str]:
    """Per document the digest of its groups as text; empty where there are none.

    ``names`` holds the texts of A ids with a comma and with a bar, then from ``b_first`` those of B ids with a comma
    and with a semicolon. Tokens are put in order by group, side and place; the order follows from running counts. The
    values of the gathered texts lie behind each other, so a document's text is one slice of them.
    """
    has_a, has_b = (cells.column(f"{side}_id").is_valid().to_numpy() for side in "ab")
    closes = has_a & has_b
    group = np.cumsum(closes) - closes
    parts, places, parents = [], [], []
    per_group = [np.bincount(group[has], minlength=int(closes.sum())) for has in (has_a, has_b)]
    upto = [np.cumsum(counts) for counts in per_group]
    for side, has, base in (("a", has_a, 0), ("b", has_b, b_first)):
        ids, last, own = cells.column(f"{side}_id").drop_null().to_numpy(), closes[has], group[has]
        width = b_first // 2 if side == "a" else (len(names) - b_first) // 2
        parts.append(base + ids + last * width)
        places.append(np.arange(len(ids)) + (upto[1][own] - per_group[1][own] if side == "a" else upto[0][own]))
        parents.append(cells.column("key").to_numpy()[has] >> END_BITS)
    codes = np.empty(sum(map(len, parts)), np.int64)
    owner = np.empty(len(codes), np.int64)
    for part, place, parent in zip(parts, places, parents, strict=True):
        codes[place], owner[place] = part, parent
    gathered = pc.take(names, pa.array(codes))
    _, offsets, values = gathered.buffers()
    starts = np.frombuffer(offsets, np.int64)[gathered.offset :] if len(codes) else np.zeros(1, np.int64)
    edges = starts[np.searchsorted(owner, np.arange(documents + 1))]
    shown = memoryview(values) if len(codes) else b""
    # Without the last semicolon.
    return [hashlib.sha256(shown[begin : end - 1]).hexdigest() if end > begin else "" for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


class Aligner:
    """Both vocabularies and the texts of their ids."""

    def __init__(self, byte_vocabulary: str, piece_vocabulary: str):
        self.a, self.b = byte_chunks(byte_vocabulary, plain_specials=True), piece_chunks(piece_vocabulary)
        self.lengths = [pa.array(side.lengths) for side in (self.a, self.b)]
        n_a, n_b = len(self.a.tokens), len(self.b.tokens)
        shown = [f"{i}," for i in range(n_a)] + [f"{i}|" for i in range(n_a)] + [f"{i}," for i in range(n_b)] + [f"{i};" for i in range(n_b)]
        self.names, self.b_first = pa.array(shown, pa.large_string()), 2 * n_a

    def tokens(self, texts: list[str | None]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of both sides; none where either does not spell the text."""
        none = np.zeros(0, np.int64)
        given = [text or "" for text in texts]
        found = self.a.encode_spaced(given), self.b.exact_spaced(given)
        sizes = [len(text.encode()) + 1 if text else 0 for text in texts]
        spells = lambda i: all(int(side.lengths[ids[i]].sum()) == sizes[i] for side, ids in zip((self.a, self.b), found, strict=True))
        spelt = [size > 0 and spells(i) for i, size in enumerate(sizes)]
        return tuple(_lists([x if ok else none for x, ok in zip(ids, spelt, strict=True)]) for ids in found)

    def block(self, doc_ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
        """Rows of the documents of a block, and one row with its pairs and their counts."""
        n = len(texts)
        lists = self.tokens(texts)
        cells = _cells(*[_ends(x, lengths) for x, lengths in zip(lists, self.lengths, strict=True)])
        document = pc.shift_right(cells.column("key"), pa.scalar(END_BITS, pa.int64()))
        closes = pc.and_(cells.column("a_id").is_valid(), cells.column("b_id").is_valid())
        per_document = lambda parents: np.bincount(parents.to_numpy(), minlength=n)
        digests = _digests(cells, n, self.names, self.b_first)
        pair = pc.add(
            pc.shift_left(pc.fill_null_backward(cells.column("a_id")), pa.scalar(B_BITS, pa.int64())),
            pc.fill_null_backward(cells.column("b_id")),
        )
        links = pa.table({"document": document, "pair": pair}).group_by(["document", "pair"], use_threads=False).aggregate([([], "count_all")])
        partial = links.group_by("pair", use_threads=False).aggregate([("count_all", "sum")]).sort_by("pair")
        pairs = partial.column("pair").combine_chunks()
        links = links.append_column("code", pc.index_in(links.column("pair"), value_set=pairs)).sort_by([("document", "ascending"), ("code", "ascending")])
        offsets = pa.array(np.append(np.searchsorted(links.column("document").to_numpy(), np.arange(n + 1)), links.num_rows), pa.int32())
        nulls = lambda kind: pa.nulls(1, kind)
        plain = [np.diff(lists[0].offsets.to_numpy()), np.diff(lists[1].offsets.to_numpy()), per_document(document.filter(closes)), per_document(document)]
        one_list = lambda values, kind: pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(values)], pa.int32()), values.cast(kind))
        codes = pa.ListArray.from_arrays(offsets, links.column("code").combine_chunks().cast(pa.int32()))
        # The last row, whose codes are empty, is the block's own: its pairs, and their counts behind those of the documents.
        counts = pa.ListArray.from_arrays(
            pa.array([*offsets.to_pylist()[:-1], links.num_rows + partial.num_rows], pa.int32()),
            pa.concat_arrays([links.column("count_all").combine_chunks(), partial.column("count_all_sum").combine_chunks()]),
        )
        columns = [
            pa.array([uuid.uuid4().hex] * (n + 1)),
            pa.concat_arrays([doc_ids.cast(pa.int64()), nulls(pa.int64())]),
            *[pa.concat_arrays([pa.array(values, pa.int64()), nulls(pa.int64())]) for values in plain],
            pa.array([*digests, None], pa.string()),
            codes,
            counts,
            one_list(pairs, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in ALIGNED.split(", ")])


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_vocabulary: str, piece_vocabulary: str) -> Aligner:
    """The aligner of two vocabularies, one per process."""
    key = byte_vocabulary, piece_vocabulary
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Slices of rows of about ``BLOCK_BYTES`` of text."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len((text or "").encode())
        if size >= BLOCK_BYTES:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def aligned_blocks(docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY) -> DataFrame:
    """Stored rows of documents and of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_vocabulary, piece_vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, end in _blocks(texts):
                yield tool.block(batch.column("doc_id").slice(begin, end - begin), texts[begin:end])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(chosen.mapInArrow(run, ALIGNED), "alignment-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Links of every pair of ids in the corpus: pair, links, and whether no pair of its B id has more."""
    partial = blocks.where("n_a IS NULL").select(F.explode(F.arrays_zip("pairs", "counts")).alias("part"))
    merged = partial.groupBy(F.col("part.pairs").alias("pair")).agg(F.sum("part.counts").alias("links"))
    # A B id meets at most as many ids as vocabulary A has, so a window partition is bounded.
    of_b = Window.partitionBy(F.expr(f"pair & {(1 << B_BITS) - 1}L"))
    return merged.withColumn("best", F.col("links") == F.max("links").over(of_b))


def _summed(documents: pa.Table, scores: pa.Table) -> pa.Table:
    """Documents of a block with the sums over their links."""
    scores = scores.sort_by("code")
    documents = documents.combine_chunks()
    codes, counts = documents.column("codes").combine_chunks(), documents.column("counts").combine_chunks()
    flat, weight = pc.list_flatten(codes).cast(pa.int64()), pc.list_flatten(counts)
    parents = pc.list_parent_indices(codes).to_numpy()
    sums = []
    for column in ("best", "links"):
        value = pc.multiply(pc.take(scores.column(column).cast(pa.int64()), flat), weight)
        running = np.concatenate([[0], np.cumsum(value.to_numpy())])
        edges = np.searchsorted(parents, np.arange(documents.num_rows + 1))
        sums.append(pa.array(running[edges[1:]] - running[edges[:-1]], pa.int64()))
    names = [part.split()[0] for part in REPORT.split(", ")]
    return documents.append_column("n_best", sums[0]).append_column("count_sum", sums[1]).select(names)


def aligned_documents(docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY) -> DataFrame:
    """Per document: tokens of both sides, groups, links, the links that are the best of their B id, and all counts summed."""
    prepare(docs.sparkSession)
    blocks = aligned_blocks(docs, byte_vocabulary, piece_vocabulary)
    totals = stored(pair_counts(blocks), "alignment-pairs")
    asked = blocks.where("n_a IS NULL").select(F.col("block").alias("scored_block"), F.posexplode("pairs").alias("code", "pair"))
    scores = asked.join(totals, "pair").select("scored_block", "code", "links", "best")
    documents = blocks.where("n_a IS NOT NULL").drop("pairs")
    return documents.groupBy("block").cogroup(scores.groupBy("scored_block")).applyInArrow(_summed, REPORT)
