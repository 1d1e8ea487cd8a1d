"""Joins with a dimension where a few keys hold a large share of the fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with at least 1 / HOT_PARTS of the rows is hot; so at most HOT_PARTS keys are. The sketch tracks enough items to
# find all of them.
HOT_PARTS = 200
TRACKED = 1 << 13


def hot_keys(facts: DataFrame, key: str) -> DataFrame:
    """(key) of the hot keys, at most ``HOT_PARTS`` rows, from one frequent-items sketch."""
    sketch = facts.agg(F.expr(f"approx_top_k(`{key}`, {HOT_PARTS}, {TRACKED})").alias("top"), F.count(key).alias("n"))
    counted = sketch.select("n", F.explode("top").alias("entry"))
    return counted.filter(F.col("entry.count") * HOT_PARTS >= F.col("n")).select(F.col("entry.item").alias(key))


def with_spread_key(facts: DataFrame, hot_rows: DataFrame, key: str, spread_by: str) -> DataFrame:
    """The facts with the dimension's row of their key where that is hot (``hot``, else null), and ``spread_key`` for the rest.

    The spread key of a hot row is one that no dimension row has, made from another column, so these rows are dealt
    evenly by the shuffle of the rest.
    """
    known = facts.join(F.broadcast(hot_rows), key, "left")
    apart = F.concat(F.lit("\u0000"), F.col(spread_by).cast("string"))
    return known.withColumn("spread_key", F.when(F.col("hot").isNull(), F.col(key).cast("string")).otherwise(apart))


def join_dimension(facts: DataFrame, dimension: DataFrame, key: str, column: str, spread_by: str) -> DataFrame:
    """Facts of known keys with one column of the dimension, whose key is unique.

    Hot keys meet their dimension rows, a bounded few, by broadcast; all others by a shuffle that hot rows do not skew.
    """
    row = dimension.select(key, F.struct(F.col(column).alias("value")).alias("hot"))
    hot_rows = row.join(hot_keys(facts, key), key, "left_semi").limit(HOT_PARTS)
    rest = dimension.select(F.col(key).cast("string").alias("spread_key"), F.struct(F.col(column).alias("value")).alias("cold"))
    joined = with_spread_key(facts, hot_rows, key, spread_by).join(rest, "spread_key", "left")
    found = F.coalesce("hot", "cold")
    return joined.filter(found.isNotNull()).withColumn(column, found["value"]).drop("hot", "cold", "spread_key")
