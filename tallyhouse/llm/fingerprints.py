"""Order MinHash fingerprints with built-in functions only.

A text is its sequence of k-mers of words. Each k-mer is numbered by its occurrence in the text, so repeats differ.
For every one of ``TUPLES`` hash functions the minimal numbered k-mers are selected, one of each half of the hash
range; they are put in text order and hashed as a tuple. The fingerprint is the list of tuple hashes. Moving or
replacing a passage changes both which k-mers are minimal and their order, so the share of equal tuples falls with the
edit distance.

Likeness moves in steps of 1 / ``TUPLES``; an estimate of a share p is off by sqrt(p (1 - p) / 24), so 0.09 at p = 0.25, the share
of tuples that outlives the replacement of a third of a text. All 24 miss such a text once in a thousand (0.75 ** 24).

Defined cases: null and empty texts are one empty word; fewer words than a k-mer are one k-mer; places beyond 2^24 wrap;
equal texts have equal fingerprints. Neighbours go by distinct
doc_id in descending order, null last, and the last is followed by the first (a single document by itself); rows that
repeat a doc_id are all kept, and as a neighbour count with their smallest beginning and fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.session import stored

KMER_WORDS = 3
TUPLES = 24
PLACE_BITS = 24  # low bits of a packed value hold the place of the k-mer
NO_ID = -(1 << 63)  # stands for a null doc_id in keys

_PLACE = (1 << PLACE_BITS) - 1


def _from(column: str, step: int) -> Column:
    """An array without its first ``step`` elements."""
    return F.slice(column, step + 1, F.greatest(F.size(column) - step, F.lit(0)))


def kmer_hashes(words: str, size: int = KMER_WORDS) -> Column:
    """Hashes of all k-mers of words in text order."""
    all_ = F.transform(words, lambda w: F.xxhash64(w))
    for step in range(1, size):
        all_ = F.zip_with(all_, _from(words, step), lambda h, w: F.xxhash64(h, w))
    all_ = F.slice(all_, 1, F.greatest(F.size(words) - (size - 1), F.lit(0)))
    return F.when(F.size(words) >= size, all_).otherwise(F.array(F.xxhash64(words)))


def _kmer(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, PLACE_BITS)


def with_kmers(rows: DataFrame, text: str, column: str) -> DataFrame:
    """The rows with an array of numbered k-mers: (hash of k-mer and occurrence, place in the text).

    White space separates words (at the ends of a text it leaves an empty one). Occurrences are numbered by sorting
    the k-mers, packed with their places into one number; the other steps are linear.
    """
    words, hashes, ordered, firsts, numbers = (f"_{column}{i}" for i in range(5))
    rows = rows.withColumn(words, F.split(F.coalesce(text, F.lit("")), r"\s+"))
    rows = rows.withColumn(hashes, kmer_hashes(words))
    packed = F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long").bitwiseAND(F.lit(_PLACE))))
    rows = rows.withColumn(ordered, F.sort_array(packed))
    # Places where a new k-mer begins among the sorted ones; the last element pairs with none.
    same = F.zip_with(ordered, _from(ordered, 1), lambda a, b: _kmer(a) == _kmer(b))
    rows = rows.withColumn(firsts, F.concat(F.array(F.lit(0)), F.filter(F.transform(same, lambda s, i: F.when(~s, i + 1)), lambda i: i.isNotNull())))
    runs = F.zip_with(firsts, F.concat(_from(firsts, 1), F.array(F.size(ordered))), lambda a, b: b - a)
    rows = rows.withColumn(numbers, F.flatten(F.transform(runs, lambda n: F.sequence(F.lit(0), n - 1))))
    numbered = F.zip_with(ordered, numbers, lambda p, o: F.struct(F.xxhash64(_kmer(p), o).alias("kmer"), p.bitwiseAND(F.lit(_PLACE)).alias("place")))
    return rows.withColumn(column, numbered).drop(words, hashes, ordered, firsts, numbers)


def fingerprint_columns(kmer: Column, place: Column, tuples: int = TUPLES) -> list[Column]:
    """Per hash function, the smallest packed (hash, place) of either half of the hash range."""
    out = []
    for seed in range(tuples):
        value = F.xxhash64(kmer, F.lit(seed))
        packed = value.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place)
        out += [F.min(F.when(value < 0, packed)).alias(f"a{seed}"), F.min(F.when(value >= 0, packed)).alias(f"b{seed}")]
    return out


def tuple_hashes(tuples: int = TUPLES) -> Column:
    """The tuples of minimal k-mers, in text order, as hashes."""
    out = []
    for seed in range(tuples):
        a, b = F.col(f"a{seed}"), F.col(f"b{seed}")
        ahead = a.bitwiseAND(F.lit(_PLACE)) < b.bitwiseAND(F.lit(_PLACE))
        out.append(F.when(ahead | b.isNull(), F.xxhash64(_kmer(a), _kmer(b))).otherwise(F.xxhash64(_kmer(b), _kmer(a))))
    return F.array(*out)


def likeness(left: Column, right: Column) -> Column:
    """Share of equal tuples."""
    return F.aggregate(F.zip_with(left, right, lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda n, x: n + x) / F.size(left)


def as_text(fingerprint: Column) -> Column:
    """Fingerprint as text, 16 hexadecimal digits per tuple."""
    return F.array_join(F.transform(fingerprint, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def fingerprints(rows: DataFrame, texts: dict[str, str], tuples: int = TUPLES) -> DataFrame:
    """The rows without their texts, with the fingerprint of each named text column.

    Numbered k-mers are generated and combined within the partition of the rows; the only columns that meet them are
    the others of the rows, which should be small.
    """
    kept = [c for c in rows.columns if c not in texts]
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    for text, name in texts.items():
        rows = with_kmers(rows, text, f"_k_{name}")
    sides = F.array(*[F.struct(F.lit(side).alias("side"), F.col(f"_k_{name}").alias("kmers")) for side, name in enumerate(texts.values())])
    each = rows.select(*kept, "_row", F.explode(sides).alias("_s")).select(*kept, "_row", "_s.side", F.explode_outer("_s.kmers").alias("_k"))
    found = each.groupBy(*kept, "_row", "side").agg(*fingerprint_columns(F.col("_k.kmer"), F.col("_k.place"), tuples))
    found = found.select(*kept, "_row", "side", tuple_hashes(tuples).alias("_f"))
    by_side = [F.max(F.when(F.col("side") == side, F.col("_f"))).alias(name) for side, name in enumerate(texts.values())]
    return found.groupBy(*kept, "_row").agg(*by_side).drop("_row")


def followers(docs: DataFrame) -> DataFrame:
    """Every key and the next one in descending order; ranges of keys are ordered apart and joined at their ends."""
    keys = docs.select("key").distinct()
    sliced = stored(keys.repartitionByRange("key").withColumn("slice", F.spark_partition_id()), "slices")
    tops = sliced.groupBy("slice").agg(F.max("key").alias("top"))
    # One row per slice from here on: the window sees no documents.
    after = F.lag("top").over(Window.orderBy("slice"))
    ends = tops.crossJoin(sliced.agg(F.max("key").alias("first"))).select("slice", F.coalesce(after, "first").alias("beyond"))
    within = F.lead("key").over(Window.partitionBy("slice").orderBy(F.col("key").desc()))
    return sliced.withColumn("in_slice", within).join(ends, "slice").select("key", F.coalesce("in_slice", "beyond").alias("next"))


def with_edits(docs: DataFrame) -> DataFrame:
    """doc_id, key, next, n_chars, text, edited: the last third of the text gives way to the next document's beginning."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    third = F.floor(F.length("text") / 3).cast("int")
    order = stored(followers(texts), "followers")
    needs = texts.join(order, "key").groupBy("key", "next").agg(F.max(third).alias("need"))
    heads = texts.withColumnRenamed("key", "next").join(needs, "next").select("key", "next", F.expr("substring(text, 1, need)").alias("head"))
    heads = heads.groupBy("key", "next").agg(F.min("head").alias("head"))
    joined = texts.join(heads, "key")
    edited = F.concat(F.expr("substring(text, 1, length(text) - CAST(floor(length(text) / 3) AS INT))"), F.expr("substring(head, 1, CAST(floor(length(text) / 3) AS INT))"))
    doc_id = F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id")
    return joined.select(doc_id, "key", "next", F.length("text").cast("long").alias("n_chars"), "text", edited.alias("edited"))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Per document: fingerprints of its text and of its edited text, and their likeness to each other and to the next."""
    edits = with_edits(docs).withColumn("edited_sha256", F.sha2("edited", 256))
    found = stored(fingerprints(edits, {"text": "own", "edited": "changed"}), "fingerprints")
    next_ = found.groupBy(F.col("key").alias("next")).agg(F.min("own").alias("following"))
    return found.join(next_, "next").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).cast("double").alias("near_edited"),
        likeness(F.col("own"), F.col("following")).cast("double").alias("near_next"),
    )
