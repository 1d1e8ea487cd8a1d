"""Connected components of a distributed edge list by alternating star steps.

Each step points nodes at the smallest neighbour; every step is a grouped minimum and a join, so a node with very many
edges is combined before it is shuffled and its join partition can be split. Steps are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.session import stored


def _toward_smallest(edges: DataFrame, *, upper: bool) -> DataFrame:
    """One star step. upper: neighbours above a node move to its minimum; else those below it do, and the node too."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not upper:
        both = both.where("b < a")
    lowest = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    joined = both.join(lowest, "a")
    moved = joined.where("b > a") if upper else joined
    out = moved.select(F.col("b").alias("a"), F.col("low").alias("b"))
    if not upper:
        out = out.union(lowest.select("a", F.col("low").alias("b")))
    return out.where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Count and sum of hashes, equal for equal edge sets."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """Node and the smallest node reachable from it, for every node with an edge to another; edges have a and b.

    Nulls and self-loops are dropped; repeated edges count once; no edges give no rows.
    """
    now = stored(edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = stored(_toward_smallest(_toward_smallest(now, upper=True), upper=False), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: the links join components, which are relabelled; without links nothing is done.

    labels has node and component (nodes without an edge are absent), links has a and b.
    """
    if links.isEmpty():
        return labels
    ends = links.select("a", "b")
    for side in ("a", "b"):
        own = labels.select(F.col("node").alias(side), F.col("component").alias("_found"))
        ends = ends.join(own, side, "left").withColumn(f"{side}_in", F.coalesce("_found", side)).drop("_found")
    ends = stored(ends, "joins")
    merged = stored(components(ends.select(F.col("a_in").alias("a"), F.col("b_in").alias("b"))), "merged")
    nodes = ends.select(F.col("a").alias("node"), F.col("a_in").alias("component")).union(ends.select("b", "b_in")).distinct()
    every = labels.union(nodes.join(labels, "node", "left_anti"))
    now = merged.select(F.col("node").alias("component"), F.col("component").alias("lowest"))
    out = every.join(now, "component", "left").select("node", F.coalesce("lowest", "component").alias("component"))
    return stored(out, "components")
