"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters of ``2 * STRIDE`` bytes slide over the whole text by ``STRIDE`` bytes. Filter
responses are max-pooled over overlapping chunks of ``2 * HALF_CHUNK`` bytes, each chunk gets a logit, and the mean of
the chunk logits is the logit of the document. Every byte of every text is read.

Training uses a bounded sample of labelled rows (``TRAIN_ROWS``, the smallest hashes of their ids) on the driver;
scoring runs on the executors without a shuffle.

Defined cases: a null or empty text is one chunk of padding and gets that chunk's score; labelled rows without a
document, without a label or repeated ids are dropped or used once; without any usable label every score is 0.5; an input
column with the name of the score is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.bytes import blocks
from tallyhouse.llm.session import others, unused

TRAIN_ROWS = 4000  # bound of the training sample
EPOCHS = 8
BATCH = 32
RATE = 0.004
EMBEDDING = 8
FILTERS = 40
STRIDE = 4
HALF_CHUNK = 128
KEEP_SCORE = 0.3
FOLDS = 5
PIECE_BYTES = 1 << 18  # bytes convolved at a time, so that a step stays in the processor's cache

STEPS = HALF_CHUNK // STRIDE


@dataclass
class Network:
    """Weights: byte embedding, the two halves of the filters, their bias, and the chunk's output layer."""

    embedding: np.ndarray  # 256 x EMBEDDING
    left: np.ndarray  # STRIDE * EMBEDDING x FILTERS
    right: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: np.ndarray

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        draw = np.random.default_rng(seed)
        width = STRIDE * EMBEDDING
        normal = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
        return Network(
            normal(256, EMBEDDING, scale=0.5),
            normal(width, FILTERS, scale=0.2),
            normal(width, FILTERS, scale=0.2),
            np.zeros(FILTERS, np.float32),
            normal(FILTERS, scale=0.2),
            np.zeros(1, np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.left, self.right, self.bias, self.out, self.shift]


def laid_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts padded with at least STRIDE zero bytes to two or more whole half chunks, and the first half chunk of each."""
    sizes = np.diff(offsets)
    halves = np.maximum(2, -(-(sizes + STRIDE) // HALF_CHUNK))
    first = np.concatenate([[0], np.cumsum(halves)])
    out = np.zeros(int(first[-1]) * HALF_CHUNK, np.uint8)
    for row, begin in enumerate((first[:-1] * HALF_CHUNK).tolist()):
        out[begin : begin + sizes[row]] = data[offsets[row] : offsets[row + 1]]
    return out, first


def half_maxima(net: Network, flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Largest filter response within each half chunk (a filter may read STRIDE bytes beyond it, not into the next text)."""
    last = first[1:] * STEPS - 1  # begins in padding and would read the next text
    out = np.empty((len(flat) // HALF_CHUNK, FILTERS), np.float32)
    pad = np.zeros(STRIDE, np.uint8)
    for begin in range(0, len(flat), PIECE_BYTES):
        end = min(begin + PIECE_BYTES, len(flat))
        piece = np.concatenate([flat[begin : end + STRIDE], pad])[: end - begin + STRIDE]
        embedded = net.embedding[piece].reshape(-1, STRIDE * EMBEDDING)
        response = embedded[:-1] @ net.left
        response += embedded[1:] @ net.right
        low, high = np.searchsorted(last, [begin // STRIDE, end // STRIDE])
        response[last[low:high] - begin // STRIDE] = -np.inf
        out[begin // HALF_CHUNK : end // HALF_CHUNK] = response.reshape(-1, STEPS, FILTERS).max(1)
    return out


def probabilities(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of a good label for every text."""
    flat, first = laid_out(data, offsets)
    halves = half_maxima(net, flat, first)
    chunks = np.maximum(np.maximum(halves[:-1], halves[1:]) + net.bias, 0)
    logits = chunks @ net.out
    logits = np.append(logits, np.float32(0))
    logits[first[1:] - 1] = 0  # a chunk does not reach into the next text
    total = np.add.reduceat(logits, first[:-1])
    mean = total / (np.diff(first) - 1) + net.shift[0]
    return 1 / (1 + np.exp(-np.clip(mean.astype(np.float64), -30, 30)))


def _gradients(net: Network, flat: np.ndarray, first: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Gradient of the mean log loss of a batch; only the largest response of each chunk takes part."""
    bytes_ = np.concatenate([flat, np.zeros(STRIDE, np.uint8)])
    embedded = net.embedding[bytes_].reshape(-1, STRIDE * EMBEDDING)
    response = embedded[:-1] @ net.left + embedded[1:] @ net.right
    response[first[1:] * STEPS - 1] = -np.inf
    response = response.reshape(-1, STEPS, FILTERS)
    best = response.argmax(1)
    top = np.take_along_axis(response, best[:, None, :], 1)[:, 0]
    second = top[1:] > top[:-1]
    peak = np.where(second, top[1:], top[:-1]) + net.bias
    active = np.maximum(peak, 0)
    logits = np.append(active @ net.out, np.float32(0))
    logits[first[1:] - 1] = 0
    count = np.diff(first) - 1
    score = np.add.reduceat(logits, first[:-1]) / count + net.shift[0]
    error = (1 / (1 + np.exp(-score)) - label) / len(label)
    per_chunk = np.repeat(error / count, np.diff(first))
    per_chunk[first[1:] - 1] = 0
    per_chunk = per_chunk[:-1].astype(np.float32)
    d_peak = per_chunk[:, None] * net.out * (peak > 0)
    row = np.arange(len(second))[:, None] + second
    at = row * STEPS + np.where(second, best[1:], best[:-1])
    d_left, d_right = np.empty_like(net.left), np.empty_like(net.right)
    d_embedding = np.zeros_like(net.embedding)
    tiled = bytes_.reshape(-1, STRIDE)
    for k in range(FILTERS):
        used = np.flatnonzero(d_peak[:, k])
        weight, place = d_peak[used, k], at[used, k]
        d_left[:, k] = weight @ embedded[place]
        d_right[:, k] = weight @ embedded[place + 1]
        for half, offset in ((net.left, 0), (net.right, 1)):
            for tap in range(STRIDE):
                share = np.bincount(tiled[place + offset, tap], weight, 256).astype(np.float32)
                d_embedding += share[:, None] * half[tap * EMBEDDING : (tap + 1) * EMBEDDING, k]
    return [d_embedding, d_left, d_right, d_peak.sum(0), per_chunk @ active, np.array([error.sum()], np.float32)]


def trained(texts: list[bytes], labels: list[int], seed: int = 7) -> Network | None:
    """Adam on the log loss; None without texts. The order of the rows is fixed by the seed."""
    if not texts:
        return None
    net, draw = Network.fresh(seed), np.random.default_rng(seed)
    parts = net.parts()
    mean, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    truth, step = np.array(labels, np.float32), 0
    total = EPOCHS * -(-len(texts) // BATCH)
    for _ in range(EPOCHS):
        order = draw.permutation(len(texts))
        for begin in range(0, len(order), BATCH):
            rows = order[begin : begin + BATCH]
            chosen = [texts[i] for i in rows]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in chosen])])
            flat, first = laid_out(np.frombuffer(b"".join(chosen), np.uint8), offsets)
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for part, gradient, m, s in zip(parts, _gradients(net, flat, first, truth[rows]), mean, square, strict=True):
                m += 0.1 * (gradient - m)
                s += 0.01 * (gradient * gradient - s)
                part -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
    return net


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: crc32 of the id as text leaves no remainder by FOLDS."""
    return F.coalesce(F.crc32(doc_id.cast("string")), F.lit(0)) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[bytes], list[int]]:
    """A bounded sample of labelled texts that are not held out; one text of each id comes to the driver, the smallest."""
    usable = (
        labels.select("doc_id", F.col("quality").cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    chosen = usable.collect()
    known = {row["doc_id"]: row["label"] for row in chosen}
    of_known = docs.select("doc_id", "text").where(F.col("doc_id").isin(list(known)) & F.col("text").isNotNull())
    got = of_known.groupBy("doc_id").agg(F.min("text").alias("text")).collect()
    first = {row["doc_id"]: row["text"].encode() for row in sorted(got, key=lambda r: r["doc_id"])}
    return list(first.values()), [known[i] for i in first]


def scored(docs: DataFrame, net: Network | None, text_column: str = "text", score: str = "quality_score") -> DataFrame:
    """The documents with one more column, the probability of a good label."""
    docs = others(docs, score)
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])
    names = [*docs.columns, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in blocks(batch, text_column):
                got = np.full(part.num_rows, 0.5) if net is None else probabilities(net, data, offsets)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.float64())], names)

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = KEEP_SCORE) -> DataFrame:
    """The documents whose score reaches the threshold."""
    net = trained(*training_rows(docs, labels))
    score = unused(docs, "quality_score")
    return scored(docs, net, score=score).where(F.col(score) >= threshold).select(*docs.columns)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: held out or not, score, and the label it predicts."""
    rated = scored(docs.select("doc_id", "text"), trained(*training_rows(docs, labels)), score="score")
    return rated.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )
