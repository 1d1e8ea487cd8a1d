"""The classifier against scalar loops and numeric gradients, fingerprints against a plain Order MinHash."""

from __future__ import annotations

import re
import struct
from collections import Counter

import numpy as np
import xxhash

from tallyhouse.llm import fingerprints, quality
from tallyhouse.llm.session import prepare

TEXTS = [b"", b"a", b"plain words of a text " * 30, bytes(range(256)) * 3, "é 你 😀".encode() * 40]


def network(seed=1):
    net = quality.Network.fresh(seed)
    draw = np.random.default_rng(seed)
    net.bias += draw.standard_normal(net.bias.shape).astype(np.float32) * 0.1
    net.shift += np.float32(0.3)
    return net


def scalar_logit(net, text):
    """Chunk by chunk and filter by filter; a chunk is two half chunks, filters start every STRIDE bytes in it."""
    halves = max(2, -(-(len(text) + quality.STRIDE) // quality.HALF_CHUNK))
    padded = text + bytes(halves * quality.HALF_CHUNK - len(text))
    weights = np.concatenate([net.left, net.right])
    logits = []
    for chunk in range(halves - 1):
        total = 0.0
        for k in range(quality.FILTERS):
            best = -np.inf
            begin = chunk * quality.HALF_CHUNK
            for at in range(begin, begin + 2 * quality.HALF_CHUNK, quality.STRIDE):
                window = padded[at : at + 2 * quality.STRIDE]
                if len(window) < 2 * quality.STRIDE:
                    continue  # it would reach beyond the text
                best = max(best, float(np.concatenate([net.embedding[b] for b in window]) @ weights[:, k]))
            total += max(0.0, best + float(net.bias[k])) * float(net.out[k])
        logits.append(total)
    return sum(logits) / len(logits) + float(net.shift[0])


def packed(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def test_scores_equal_scalar_convolution(monkeypatch):
    net = network()
    want = [1 / (1 + np.exp(-scalar_logit(net, text))) for text in TEXTS]
    for piece in (quality.PIECE_BYTES, quality.HALF_CHUNK):
        monkeypatch.setattr(quality, "PIECE_BYTES", piece)
        assert np.allclose(quality.probabilities(net, *packed(TEXTS)), want, atol=1e-4)


def loss(net, data, offsets, labels):
    p = quality.probabilities(net, data, offsets)
    return float(-np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p)))


def test_gradients_equal_differences():
    net, labels = network(2), np.array([0, 1, 1, 0, 1], np.float32)
    for name in ("embedding", "left", "right", "bias", "out", "shift"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    data, offsets = packed(TEXTS)
    flat, first = quality.laid_out(data, offsets)
    gradients = quality._gradients(net, flat, first, labels)
    draw, step = np.random.default_rng(3), 1e-3
    close = total = 0
    for part, gradient in zip(net.parts(), gradients, strict=True):
        for _ in range(8):
            place = tuple(int(draw.integers(n)) for n in part.shape)
            held = part[place]
            part[place] = held + step
            above = loss(net, data, offsets, labels)
            part[place] = held - step
            below = loss(net, data, offsets, labels)
            part[place] = held
            total += 1
            close += abs((above - below) / (2 * step) - gradient[place]) < 2e-3 + 0.05 * abs(gradient[place])
    assert close >= total - 2, (close, total)  # a difference may step over a change of the largest response


# Spark's xxhash64: values are hashed one after the other, each with the hash so far as seed, 42 first.


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def hashed(*values):
    seed = 42
    for value in values:
        data = value.encode() if isinstance(value, str) else struct.pack("<q", value) if abs(value) > 1 << 31 or isinstance(value, np.int64) else struct.pack("<i", value)
        if isinstance(value, int) and not isinstance(value, np.int64) and len(data) == 4:
            seed = xx_int(value, seed)
        else:
            seed = xxhash.xxh64_intdigest(data, seed & ((1 << 64) - 1))
    return signed(seed)


def xx_int(value, seed):
    """XXH64 of four bytes."""
    return xxhash.xxh64_intdigest(struct.pack("<i", value), seed & ((1 << 64) - 1))


def plain_fingerprint(text):
    words = re.split(r"\s+", text or "")
    size, places = fingerprints.KMER_WORDS, (1 << fingerprints.PLACE_BITS) - 1
    if len(words) < size:
        # An array is hashed element by element.
        hashes = [hashed(*words)]
    else:
        hashes = []
        for i in range(len(words) - size + 1):
            value = hashed(words[i])
            for step in range(1, size):
                value = signed(xxhash.xxh64_intdigest(words[i + step].encode(), xxhash.xxh64_intdigest(struct.pack("<q", value), 42)))
            hashes.append(value)
    kmers = [(h & ~places) | (i & places) for i, h in enumerate(hashes)]
    seen, numbered = Counter(), []
    unsigned = lambda v: (v & ((1 << 64) - 1)) >> fingerprints.PLACE_BITS
    for packed_ in sorted(kmers):
        high = unsigned(packed_)
        number = seen[high]
        seen[high] += 1
        kmer = signed(xx_int(number, xxhash.xxh64_intdigest(struct.pack("<q", high), 42)))
        numbered.append((kmer, packed_ & places))
    out = []
    for seed in range(fingerprints.TUPLES):
        below, above = [], []
        for kmer, place in numbered:
            value = signed(xx_int(seed, xxhash.xxh64_intdigest(struct.pack("<q", kmer), 42)))
            (below if value < 0 else above).append((value & ~places) | place)
        ends = [min(side) for side in (below, above) if side]
        ends.sort(key=lambda v: v & places)
        pair = [unsigned(v) for v in ends]
        state = 42
        for value in pair:
            state = xxhash.xxh64_intdigest(struct.pack("<q", value), state)
        out.append(f"{state:016x}")
    return "".join(out)


def test_fingerprints_equal_a_plain_order_minhash(spark):
    texts = ["one two three four five six seven eight nine ten " * 3, "a b c", "a b a b a b a b a b", "word " * 50, " lead and trail ", "é 你 😀 x y z é 你 😀", "three words here and more of them to follow in this text"]
    docs = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint_report(docs).collect()}
    assert [found[i] for i in range(len(texts))] == [plain_fingerprint(t) for t in texts]


def test_texts_with_a_replaced_third_keep_some_tuples(spark):
    """Of 400 texts of random words, the share of equal tuples is near its expected value and hardly ever none."""
    draw = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in draw.integers(0, 10**6, 90))) for i in range(400)]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    found = fingerprints.fingerprint_report(docs).select("near_edited", "near_next").collect()
    near = np.array([r.near_edited for r in found])
    assert 0.2 < near.mean() < 0.3 and (near == 0).mean() <= 0.01
    assert max(r.near_next for r in found) < 0.2
