"""Corpus operators that compare documents, against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyhouse.llm import components, fingerprints, jaccard, secrets, substrings
from tallyhouse.llm.session import prepare

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, texts, **more):
    rows = [(i, t, *more.values()) for i, t in enumerate(texts)]
    return prepare(spark).createDataFrame(rows, "doc_id long, text string" + "".join(f", {name} string" for name in more))


def by_id(df):
    return {row["doc_id"]: row for row in df.collect()}


def edited_copies(seed, n, words=60, edits=4):
    """Texts of which many are copies of others with a few words changed."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdeé", k=draw.randint(1, 6)))
    bases = [[word() for _ in range(words + 20 * i)] for i in range(4)]
    out = []
    for _ in range(n):
        base = list(draw.choice(bases))
        for _ in range(draw.randint(0, edits)):
            base[draw.randrange(len(base))] = word()
        out.append(" ".join(base[: draw.choice([len(base), len(base), len(base) - 3])]))
    return out


# Repeated substrings.


def spans_by_windows(texts, size=substrings.SPAN):
    """Covered bytes of every text, from counting all windows."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        covered = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - size + 1):
            if seen[d[i : i + size]] > 1:
                covered[i : i + size] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(int)])))
        out.append([tuple(x) for x in edge.reshape(-1, 2).tolist()])
    return out


def passages(seed):
    """A passage around the window's size in different surroundings, repeats within a text, and odd texts."""
    draw = random.Random(seed)
    noise = lambda n: "".join(draw.choices("abcdefgh é\n", k=n))
    shared = noise(470)
    texts = [noise(draw.randint(0, 300)) + shared[draw.randint(0, 80) : draw.randint(440, 470)] + noise(draw.randint(0, 300)) for _ in range(40)]
    texts += ["ab" * 700, "ab" * 205, noise(500) * 2, None, "", "x" * 399, "x" * 400, "x" * 401]
    return texts + texts[:2]


@pytest.mark.parametrize("hot", [512, 2])
def test_repeated_spans_equal_all_windows(spark, hot, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_BLOCKS", hot)
    texts = passages(3)
    found = by_id(substrings.repeated_spans(frame(spark, texts, _spans="clash", kept="x")))
    want = spans_by_windows(texts)
    assert [[(s["start"], s["stop"]) for s in found[i]["repeated_spans"]] for i in range(len(texts))] == want
    assert found[0]["kept"] == "x"


def test_removal_report_and_repeated_rows(spark):
    texts = passages(4)
    docs = frame(spark, texts)
    rows = by_id(substrings.removal_report(docs))
    for i, spans in enumerate(spans_by_windows(texts)):
        data = (texts[i] or "").encode()
        kept = substrings.without_spans(data, [{"start": a, "stop": b} for a, b in spans])
        assert (rows[i]["n_bytes"], rows[i]["n_spans"], rows[i]["kept_sha256"]) == (len(data), len(spans), hashlib.sha256(kept).hexdigest())
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert substrings.removal_report(nameless).count() == len(texts)
    assert substrings.removal_report(docs.limit(0)).count() == 0


def test_extension_survives_hash_collisions():
    left, right = substrings.Side(b"abcdef"), substrings.Side(b"abcxyz")
    right.hashes = list(left.hashes)
    assert left.extension(right) == 3 and left.compare(right) < 0


def test_long_texts_are_searched_in_pieces(monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", 700)
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    whole = [np.concatenate(x) for x in zip(*substrings.text_blocks(data, np.array([0, 2500, 5000])), strict=True)]
    row, first, last = whole[:3]
    windows = sorted((r, s) for r, a, b in zip(row, first, last, strict=True) for s in range(a, b + 1))
    assert windows == [(r, s) for r in (0, 1) for s in range(2500 - 399)]


# Jaccard join.


def groups_by_pairs(texts, length, percent):
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(words[i : i + length]) for i in range(len(words) - length + 1)} or ({tuple(words)} if words else set()))
    parent = list(range(len(texts)))
    find = lambda i: i if parent[i] == i else find(parent[i])
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] | sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("length", "percent", "words", "edits"), [(3, 90, 60, 4), (5, 80, 60, 4), (3, 90, 6, 2), (2, 50, 12, 8)])
def test_components_equal_all_pairs(spark, length, percent, words, edits):
    texts = edited_copies(7, 120, words, edits) + [None, "", " \n", "One", "one", "a b", "A  b", "a b c", "b a"]
    found = by_id(jaccard.grouped(frame(spark, texts, component="clash"), length, percent))
    assert [(found[i]["n_shingles"], found[i]["component_id"]) for i in range(len(texts))] == groups_by_pairs(texts, length, percent)


def test_first_of_each_group_stays(spark):
    texts = [*edited_copies(9, 60), None, None]
    docs = frame(spark, texts, doc="clash", sig="x")
    kept = jaccard.keep_first(docs)
    want = {i for i, (_, c) in enumerate(groups_by_pairs(texts, 5, 80)) if c == i}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want
    assert jaccard.keep_first(docs.limit(0)).count() == 0
    nameless = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    assert {r["component_id"] for r in jaccard.grouped(nameless).collect()} == {None}
    twice = jaccard.grouped(docs.limit(2).union(docs.limit(2)))
    assert twice.count() == 4


def test_signatures_of_similar_sets_meet():
    draw = np.random.default_rng(2)
    for size in (1, 2, 3, 5, 9, 14, 30, 77, 200, 900):
        for percent in (50, 80, 90):
            for _ in range(20):
                a = draw.integers(0, 2**63, size, np.uint64)
                common = -(-percent * 2 * size // (100 + percent))
                b = np.concatenate([a[:common], draw.integers(0, 2**63, size - min(common, size), np.uint64)])
                row = np.repeat([0, 1], [len(a), len(b)])
                owner, sig = jaccard.signatures(row, np.concatenate([np.sort(a), np.sort(b)]), 2, percent)
                same = len(np.intersect1d(a, b))
                if 100 * same >= percent * (len(a) + len(b) - same) and len(set(owner.tolist())) == 2:
                    assert set(sig[owner == 0].tolist()) & set(sig[owner == 1].tolist())


def test_odd_sketches_bound_the_difference():
    draw = np.random.default_rng(3)
    for size in (1, 40, 3000):
        a, b = draw.integers(0, 2**63, size, np.uint64), draw.integers(0, 2**63, size // 3, np.uint64)
        both = np.concatenate([a, a[: size // 2], b])
        one, two = jaccard.odd_sketches(np.repeat([0, 1], [size, len(both) - size]), both, 2).view(np.uint64)
        assert sum(int(x).bit_count() for x in one ^ two) <= size - size // 2 + len(b)


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (20, 19)]
    found = {r["node"]: r["component"] for r in components.components(prepare(spark).createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 140), 100)}
    labels = spark.createDataFrame(list(found.items()), "node long, component long")
    more = components.joined_components(labels, spark.createDataFrame([(5, 120), (200, 300)], "a long, b long"))
    joined = {r["node"]: r["component"] for r in more.collect()}
    assert joined[139] == 0 and joined[300] == 200 and len(joined) == len(found) + 2
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Fingerprints.


def test_fingerprint_edits_and_neighbours(spark):
    texts = [*edited_copies(5, 30), None, "", "é" * 10, "one two", *edited_copies(5, 2)]
    rows = by_id(fingerprints.fingerprint_report(frame(spark, texts, edited="clash", key="x")))
    order = sorted(range(len(texts)), reverse=True)
    for at, i in enumerate(order):
        text, beyond = texts[i] or "", texts[order[(at + 1) % len(order)]] or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + beyond[:third]
        assert (rows[i]["n_chars"], rows[i]["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        own = rows[i]["fingerprint"]
        tuples = lambda f: [f[k : k + 16] for k in range(0, len(f), 16)]
        share = sum(a == b for a, b in zip(tuples(own), tuples(rows[i]["edited_fingerprint"]), strict=True)) / fingerprints.TUPLES
        assert rows[i]["near_edited"] == share and 0 <= rows[i]["near_next"] <= 1
    same = defaultdict(set)
    for i, text in enumerate(texts):
        same[text or ""].add(rows[i]["fingerprint"])
    assert all(len(x) == 1 for x in same.values())


def test_numbered_kmers_equal_a_count(spark):
    texts = ["a b a b a b a b", "a", "", "x y", "a a a a a a"]
    rows = fingerprints.with_kmers(frame(spark, texts), "text", "k").select("text", "k").collect()
    for row in rows:
        words = row["text"].split(" ")
        n = max(1, len(words) - fingerprints.KMER_WORDS + 1)
        assert sorted(x["place"] for x in row["k"]) == list(range(n))
        assert len({x["kmer"] for x in row["k"]}) == n  # repeats are numbered apart


def test_fingerprints_see_order_and_odd_rows(spark):
    words = [f"w{i}" for i in range(90)]
    moved = words[45:] + words[:45]
    docs = frame(spark, [" ".join(words), " ".join(moved), " ".join(words[:80] + words[82:])])
    found = fingerprints.fingerprints(docs, {"text": "own"}).select("doc_id", "own").collect()
    own = {r["doc_id"]: r["own"] for r in found}
    near = lambda a, b: sum(x == y for x, y in zip(own[a], own[b], strict=True))
    assert near(0, 2) > near(0, 1)
    nameless = docs.union(docs).withColumn("doc_id", F.lit(None).cast("long"))
    assert fingerprints.fingerprint_report(nameless).count() == 6
    assert fingerprints.fingerprint_report(docs.limit(0)).count() == 0
    assert fingerprints.fingerprint_report(docs.limit(1)).first()["near_next"] == 1.0


# Pipeline.


def test_stages_take_effect_and_keep_columns(spark):
    docs = prepare(spark).read.parquet(f"{SMALL}/documents.parquet")
    count = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == docs.columns, name
        docs = spark.createDataFrame(after.collect(), docs.schema)
        assert 0 < docs.count() <= count
        count = docs.count()
    assert all(not secrets.text_spans(r["text"]) or secrets.MASK in r["text"] for r in docs.collect())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert len(last) == count and all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in last)


def test_pipeline_equals_brute_force_filters(spark):
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).select("doc_id").collect()}
    docs = prepare(spark).read.parquet(f"{SMALL}/documents.parquet")
    good = corpus_pipeline.good_quality(spark, docs, SMALL).orderBy("doc_id").collect()
    firsts = [good[i] for i, (_, c) in enumerate(groups_by_pairs([r["text"] for r in good], 5, 80)) if c == i]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOWER))
    windows = set()
    for item in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        found = words(item["text"])
        windows |= {tuple(found[i : i + 10]) for i in range(len(found) - 9)}
    clean = {r["doc_id"] for r in firsts if not any(tuple(words(r["text"])[i : i + 10]) in windows for i in range(len(words(r["text"])) - 9))}
    assert kept == clean
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL).limit(0)
        assert empty.count() == 0
