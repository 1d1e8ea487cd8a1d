"""Merkle manifest of a dataset: built levels as parent-linked rows, proofs by a recursive query.

Rows are leaves, ordered by id within their group; every ``FANOUT`` consecutive nodes become one parent until one node
is left, the subroot of the group. The subroots, ordered by group, form a tree of the same kind, whose last node is the
root. Each built run of children is a stored row that knows its own place and the place and slot of its parent. A
recursive query climbs from the leaves: at each step it finds the run of the current node, appends the siblings to the
proof and folds them with the hash that each leaf carries, so a changed row gives another root. The leaves of one run
share all siblings above it and climb as one row: one carried hash per leaf, one proof for all of them, to which each
leaf adds its own siblings at the end.

Order without a single task: rows are dealt by range, sorted within partitions and stored; a row's position is that in
its partition plus the sizes of the partitions before. Nodes above ``BLOCK_LEVEL`` have many leaves, so their
rows are stored once per block of ``FANOUT ** BLOCK_LEVEL`` leaves: no join key serves more leaves than one block, and
these copies are fewer than one row in 4,096 per level.

Defined cases: a null column counts as ``-``, a null group is a group of its own and comes first; null ids come first,
and rows of equal id are ordered by their hash, so equal rows are interchangeable; an empty table has no rows and no
root; the lone leaf of a group is its subroot, and a lone subroot is the root, with an empty proof. Columns beside the
named ones are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.session import prepare, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
BLOCK_LEVEL = 3
BLOCK = FANOUT**BLOCK_LEVEL
ROOT_TREE = -1
HASH_BYTES = 32


def _hashed(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _shown(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def row_hash(values: list[Column]) -> Column:
    """Digest of a row: each value as its length in bytes, a colon and itself, or ``-`` if null."""
    texts = [value.cast("string") for value in values]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return _hashed(F.concat(*parts))


def _placed(rows: DataFrame, group: str, order: list[str], purpose: str) -> DataFrame:
    """The rows with tree (a number that orders the groups), place (position in the group) and size of the group."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = stored(dealt.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), purpose)
    spans = ordered.groupBy("part", F.col(group).alias("group")).agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    whole = Window.partitionBy("group")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col("part").alias("span_part"),
        "group",
        "first",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
        F.sum("rows").over(whole).alias("size"),
        F.min("first").over(whole).alias("tree"),
    )
    same = (F.col("part") == F.col("span_part")) & F.col(group).eqNullSafe(F.col("group"))
    return ordered.join(spans, same).withColumn("place", F.col("before") + F.col("at") - F.col("first")).drop("part", "span_part", "group", "at", "first", "before")


def _next_level(nodes: DataFrame, level: int) -> DataFrame:
    """Runs of children of all trees that still have several nodes; ``size`` is the number of nodes of their level."""
    children = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", _shown(F.col("hash")).alias("h")))), lambda x: x["h"]), "")
    runs = nodes.where("size > 1").groupBy(
        "tree",
        "leaves",
        F.expr(f"(size + {FANOUT - 1}) div {FANOUT}").alias("size"),
        F.expr(f"place div {FANOUT}").alias("place"),
    )
    return runs.agg(children.alias("text")).select(
        "tree", "leaves", "size", "place", F.lit(level).alias("level"), F.unhex("text").alias("children"), _hashed(F.col("text")).alias("hash")
    )


def _levels(nodes: DataFrame, largest: int, level: int, purpose: str) -> list[DataFrame]:
    """Built levels above the given nodes, each a stored table; ``largest`` is the number of nodes of the largest tree."""
    built: list[DataFrame] = []
    while largest > 1:
        nodes = stored(_next_level(nodes, level + len(built)), purpose)
        built.append(nodes)
        largest = -(-largest // FANOUT)
    return built


@dataclass(frozen=True)
class Manifest:
    """Runs of leaves with the hash each leaf starts to climb with, the runs above with their parents, and the root."""

    families: DataFrame
    runs: DataFrame
    root: bytes | None


def _blocks(leaves: str) -> str:
    return f"sequence(0L, ({leaves} - 1) div {BLOCK})"


def _linked_runs(levels: list[DataFrame], tops: DataFrame, several_groups: bool) -> DataFrame:
    """Runs inside the groups: tree, step, place, children, hash, and the place and slot of the parent."""
    linked = None
    ranks = tops.select(F.col("tree").alias("top_tree"), "rank")
    for level, runs in enumerate(levels, start=2):
        inner = runs.where("size > 1").withColumn("up_slot", F.expr(f"place % {FANOUT}"))
        last = runs.where("size = 1").join(ranks, F.col("tree") == F.col("top_tree"))
        last = last.withColumn("up_slot", F.expr(f"rank % {FANOUT}") if several_groups else F.lit(None).cast("bigint"))
        both = inner.unionByName(last.drop("top_tree", "rank"))
        both = both.withColumn("subroot", F.when(F.col("size") == 1, F.col("hash")))
        if level > BLOCK_LEVEL:
            wide = FANOUT ** (level - BLOCK_LEVEL)
            served = f"sequence(place * {wide}L, least((place + 1) * {wide}L - 1, (leaves - 1) div {BLOCK}))"
            both = both.withColumn("place", F.explode(F.expr(served)))
        up = F.expr(f"place div {FANOUT}") if level < BLOCK_LEVEL else F.col("place")
        both = both.select("tree", F.lit(level).alias("step"), "place", "children", "hash", "subroot", up.alias("up_place"), "up_slot")
        linked = both if linked is None else linked.unionByName(both)
    return linked


def _linked_root_runs(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Runs above the subroots, once per block of leaves below them; their steps go on from the height of the group."""
    linked = None
    for level, runs in enumerate(levels, start=1):
        below = tops.select("tree", "leaves", "height", F.expr(f"rank div {FANOUT**level}L").alias("node"))
        above = runs.select(F.col("place").alias("node_place"), "size", "children", "hash")
        joined = below.join(above, F.col("node") == F.col("node_place")).withColumn("place", F.explode(F.expr(_blocks("leaves"))))
        up_slot = F.when(F.col("size") > 1, F.expr(f"node % {FANOUT}"))
        rows = joined.select(
            "tree", (F.col("height") + level).alias("step"), "place", "children", "hash",
            F.lit(None).cast("binary").alias("subroot"), F.col("place").alias("up_place"), up_slot.alias("up_slot"),
        )
        linked = rows if linked is None else linked.unionByName(rows)
    return linked


def _families(placed: DataFrame) -> DataFrame:
    """Runs of leaves: members in order, and the hash of the run; a leaf alone in its group is its own node."""
    members = F.array_sort(F.collect_list(F.struct("place", "row_id", "leaf", "carried")))
    joined = F.array_join(F.transform("members", lambda x: _shown(x["leaf"])), "")
    runs = placed.groupBy("tree", F.col("size").alias("leaves"), F.expr(f"place div {FANOUT}").alias("place")).agg(members.alias("members"))
    return runs.select(
        "tree",
        "leaves",
        F.expr(f"(leaves + {FANOUT - 1}) div {FANOUT}").alias("size"),
        "place",
        "members",
        F.when(F.col("leaves") > 1, _hashed(joined)).otherwise(F.col("members")[0]["leaf"]).alias("hash"),
    )


def build_manifest(rows: DataFrame, row_id: str, group: str, leaf: Column, carried: Column | None = None) -> Manifest:
    """The manifest of a table; ``carried`` is the hash a leaf climbs with, where it is another one than its own."""
    carried = leaf if carried is None else F.coalesce(carried, leaf)
    named = rows.select(F.col(row_id).alias("row_id"), F.col(group).alias("row_group"), leaf.alias("leaf"), carried.alias("carried"))
    hashed = stored(named.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    placed = _placed(hashed, "row_group", ["row_id", "leaf", "tie"], "merkle-order")
    families = stored(_families(placed), "merkle-families")
    largest = families.agg(F.max("size")).first()[0]
    if largest is None:
        return Manifest(families.selectExpr("*", "1 AS step", "0L AS up_place", "0L AS up_slot", "hash AS subroot"), _no_runs(families), None)
    nodes = families.drop("members")
    levels = _levels(nodes, largest, 2, "merkle-level")
    ends = nodes.where("size = 1").select("tree", "leaves", "hash", F.expr("if(leaves > 1, 1, 0)").alias("height"))
    for runs in levels:
        ends = ends.unionByName(runs.where("size = 1").select("tree", "leaves", "hash", F.col("level").alias("height")))
    ends = ends.withColumnsRenamed({"tree": "group_tree"}).withColumn("all", F.lit(ROOT_TREE))
    tops = _placed(ends, "all", ["group_tree"], "merkle-tops").drop("tree", "all")
    tops = stored(tops.withColumnsRenamed({"place": "rank", "group_tree": "tree"}), "merkle-subroots")
    groups = tops.count()
    subroots = tops.select(F.lit(ROOT_TREE).cast("bigint").alias("tree"), F.col("size").alias("leaves"), "size", F.col("rank").alias("place"), "hash")
    root_levels = _levels(subroots, groups, 1, "merkle-root-level")
    root = bytes((root_levels[-1] if root_levels else subroots).select("hash").first()[0])
    linked = _no_runs(families)
    if levels:
        linked = linked.unionByName(_linked_runs(levels, tops, groups > 1))
    if root_levels:
        linked = linked.unionByName(_linked_root_runs(root_levels, tops))
    ranks = tops.select(F.col("tree").alias("top_tree"), "rank")
    first = F.expr("if(leaves > 1, 2, 1)").alias("step")
    inner = families.where("size > 1").select(
        "*", first, F.expr(f"place div {FANOUT}").alias("up_place"), F.expr(f"place % {FANOUT}").alias("up_slot"), F.lit(None).cast("binary").alias("subroot")
    )
    up_slot = F.expr(f"rank % {FANOUT}") if groups > 1 else F.lit(None).cast("bigint")
    single = families.where("size = 1").join(ranks, F.col("tree") == F.col("top_tree"))
    single = single.select(*families.columns, first, F.lit(0).cast("bigint").alias("up_place"), up_slot.alias("up_slot"), F.col("hash").alias("subroot"))
    return Manifest(inner.unionByName(single), stored(linked, "merkle-runs"), root)


def _no_runs(nodes: DataFrame) -> DataFrame:
    names = ("children", "hash", "subroot")
    return nodes.where("false").select(
        "tree", F.lit(0).alias("step"), "place", *[F.col("hash").alias(name) for name in names], F.col("place").alias("up_place"), F.col("place").alias("up_slot")
    )


# A run of leaves: each carried hash takes its slot among the leaves of the run. A leaf alone climbs as it is.
# A step: the run of the current node gives the siblings; each carried hash takes the node's slot among them.
CLIMB = """
WITH RECURSIVE climb (tree, family, step, place, slot, folded, proof, subroot, root) AS (
  SELECT tree, place, step, up_place, up_slot,
    if(leaves = 1, transform(members, x -> x.carried),
      transform(members, (x, i) -> unhex(sha2(array_join(transform(members, (y, j) ->
        lower(hex(if(i = j, y.carried, y.leaf)))), ''), 256)))),
    CAST('' AS binary), subroot, hash
  FROM {families}
  UNION ALL
  SELECT c.tree, c.family, c.step + 1, r.up_place, r.up_slot,
    transform(c.folded, x -> unhex(sha2(lower(hex(concat(
      substring(r.children, 1, CAST({width} * c.slot AS int)), x,
      substring(r.children, CAST({width} * c.slot + {width} + 1 AS int))))), 256))),
    concat(c.proof, substring(r.children, 1, CAST({width} * c.slot AS int)),
      substring(r.children, CAST({width} * c.slot + {width} + 1 AS int))),
    coalesce(c.subroot, r.subroot), r.hash
  FROM climb c JOIN {runs} r ON r.tree = c.tree AND r.step = c.step AND r.place = c.place
  WHERE c.slot IS NOT NULL)
SELECT tree AS climbed_tree, family, folded, proof, subroot, root FROM climb WHERE slot IS NULL
"""


def proofs(manifest: Manifest) -> DataFrame:
    """Per leaf: row_id, leaf, subroot, root, proof (hex text of its siblings up to the root) and folded, the root its carried hash gives."""
    spark = prepare(manifest.families.sparkSession)
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    names = {name: f"merkle_{name}_{uuid.uuid4().hex}" for name in ("families", "runs")}
    manifest.families.createOrReplaceTempView(names["families"])
    manifest.runs.createOrReplaceTempView(names["runs"])
    climbed = spark.sql(CLIMB.format(width=HASH_BYTES, **names))
    members = manifest.families.select("tree", "place", "members")
    joined = members.join(climbed, (F.col("tree") == F.col("climbed_tree")) & (F.col("place") == F.col("family")))
    leaves = joined.select(F.posexplode("members").alias("i", "x"), "members", "folded", "proof", "subroot", "root")
    own = F.expr("array_join(transform(filter(members, (y, j) -> j <> i), y -> lower(hex(y.leaf))), '')")
    return leaves.select(
        F.col("x.row_id").alias("row_id"), F.col("x.leaf").alias("leaf"), "subroot", "root",
        F.concat(own, _shown(F.col("proof"))).alias("proof"), F.expr("folded[i]").alias("folded"),
    )


def tampering_report(docs: DataFrame) -> DataFrame:
    """Manifest of documents by source, and whether each, with the text of every fifth id lower-cased, still proves."""
    prepare(docs.sparkSession)
    text, doc_id = F.col("text"), F.col("doc_id")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = [F.translate(text, upper, upper.lower()) if name == "text" else F.col(name) for name in FIELDS]
    tampered = F.when(F.crc32(doc_id.cast("string")) % 5 == 0, row_hash(lowered))
    manifest = build_manifest(docs, "doc_id", "source", row_hash([F.col(name) for name in FIELDS]), tampered)
    climbed = proofs(manifest)
    return climbed.select(
        F.col("row_id").alias("doc_id"),
        *[_shown(F.col(name)).alias(name) for name in ("leaf", "subroot", "root")],
        F.sha2(F.col("proof"), 256).alias("proof_sha256"),
        _shown(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
