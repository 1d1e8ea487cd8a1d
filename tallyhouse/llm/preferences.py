"""Preference formatting: one prompt and two masked completions from a chosen and a rejected conversation.

Turns are rows, so the longest common prefix is a join on the turn's number and a minimum over the turns that differ.
The prefix is rendered once as the prompt, the other turns of each side as its completion. The mask of a completion
lists the spans (code points) of the texts of trained roles; all else is context.

Defined cases: a turn without role is of role "unknown"; without text, empty; turns of equal number are ordered by
role, then text; repeated rows are turns of their own; equal conversations leave empty completions; a pair with one
side has an empty prompt; rows without pair id are left out; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRAINED_ROLES = ("assistant",)


def numbered(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """pair, k (1 for the first turn), n (turns of the conversation), role, text."""
    whole = Window.partitionBy("pair")
    order = whole.orderBy(*[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")])
    named = turns.select(F.col(id_column).alias("pair"), "turn", "role", "text").where("pair IS NOT NULL")
    return named.select("pair", F.row_number().over(order).alias("k"), F.count("*").over(whole).alias("n"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _opening(role):
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def _rendered(side: str):
    return F.concat(_opening(F.col(f"{side}_role")), F.col(f"{side}_text"), F.lit("\n"))


def _in_order(column, chosen):
    """Texts of the chosen turns joined by turn number."""
    found = F.array_sort(F.collect_list(F.when(chosen, F.struct("k", column.alias("x")))))
    return F.array_join(F.transform(found, lambda t: t["x"]), "")


def format_pairs(chosen: DataFrame, rejected: DataFrame, trained: tuple[str, ...] = TRAINED_ROLES) -> DataFrame:
    """pair, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask from turns (pair, k, role, text)."""
    side = lambda rows, name: rows.select("pair", "k", F.col("role").alias(f"{name}_role"), F.col("text").alias(f"{name}_text"))
    both = side(chosen, "c").join(side(rejected, "r"), ["pair", "k"], "full")
    differs = ~(F.col("c_role").eqNullSafe(F.col("r_role")) & F.col("c_text").eqNullSafe(F.col("r_text")))
    both = both.withColumn("first", F.min(F.when(differs, F.col("k"))).over(Window.partitionBy("pair")))
    rest = F.coalesce(F.col("k") >= F.col("first"), F.lit(False))
    before = Window.partitionBy("pair").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    for name in ("c", "r"):
        size = F.when(rest, F.length(_rendered(name)))
        start = F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length(_opening(F.col(f"{name}_role")))
        both = both.withColumn(f"{name}_span", F.when(F.col(f"{name}_role").isin(*trained), F.concat_ws(":", start.cast("string"), (start + F.length(f"{name}_text")).cast("string"))))
    mask = lambda name: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(rest & F.col(f"{name}_span").isNotNull(), F.struct("k", F.col(f"{name}_span").alias("x"))))), lambda t: t["x"]), ",")
    return both.groupBy("pair").agg(
        F.count(F.when(~rest, 1)).alias("n_prompt_turns"),
        _in_order(_rendered("c"), ~rest).alias("prompt"),
        _in_order(_rendered("c"), rest & F.col("c_role").isNotNull()).alias("chosen"),
        _in_order(_rendered("r"), rest & F.col("r_role").isNotNull()).alias("rejected"),
        mask("c").alias("chosen_mask"),
        mask("r").alias("rejected_mask"),
    )


def swapped_endings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns of a plain conversation table: the rejected side of each conversation ends with the
    last turn of its partner (ids 2i and 2i + 1), or without its last turn where there is no partner."""
    own = numbered(turns)
    lengths = own.where("k = n").select("pair", "n")
    endings = own.where("k = n").select(F.col("pair").bitwiseXOR(F.lit(1)).alias("pair"), "role", "text")
    moved = endings.join(lengths, "pair").select("pair", F.col("n").cast("int").alias("k"), "role", "text")
    return own.select("pair", "k", "role", "text"), own.where("k < n").select("pair", "k", "role", "text").unionByName(moved)


def preference_report(turns: DataFrame) -> DataFrame:
    """Per conversation, its formatted preference pair."""
    return format_pairs(*swapped_endings(turns)).withColumnRenamed("pair", "conv_id")


PREFERENCE_SQL = """
WITH own AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce("text", '') AS body,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, "text" NULLS FIRST) AS k,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), ends AS (
  SELECT conv_id, max(n) AS n, max(CASE WHEN k = n THEN role END) AS role, max(CASE WHEN k = n THEN body END) AS body
  FROM own GROUP BY conv_id
), turns AS (
  SELECT o.conv_id, o.k, o.role AS c_role, o.body AS c_body,
         CASE WHEN o.k < o.n THEN o.role ELSE e.role END AS r_role, CASE WHEN o.k < o.n THEN o.body ELSE e.body END AS r_body
  FROM own o LEFT JOIN ends e ON e.conv_id = xor(o.conv_id, 1)
), marked AS (
  SELECT *, coalesce(min(CASE WHEN r_role IS NULL OR c_role <> r_role OR c_body <> r_body THEN k END) OVER (PARTITION BY conv_id), 1000000000) AS cut
  FROM turns
), sized AS (
  SELECT *, '<|' || c_role || '|>' || chr(10) AS c_open, '<|' || r_role || '|>' || chr(10) AS r_open,
         coalesce(sum(CASE WHEN k >= cut THEN length(c_role) + length(c_body) + 6 END) OVER w, 0) AS c_at,
         coalesce(sum(CASE WHEN k >= cut THEN length(r_role) + length(r_body) + 6 END) OVER w, 0) AS r_at
  FROM marked WINDOW w AS (PARTITION BY conv_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT conv_id,
       count(*) FILTER (k < cut) AS n_prompt_turns,
       coalesce(string_agg(c_open || c_body || chr(10), '' ORDER BY k) FILTER (k < cut), '') AS prompt,
       coalesce(string_agg(c_open || c_body || chr(10), '' ORDER BY k) FILTER (k >= cut), '') AS chosen,
       coalesce(string_agg(r_open || r_body || chr(10), '' ORDER BY k) FILTER (k >= cut AND r_role IS NOT NULL), '') AS rejected,
       coalesce(string_agg((c_at + length(c_open))::BIGINT || ':' || (c_at + length(c_open) + length(c_body))::BIGINT, ',' ORDER BY k) FILTER (k >= cut AND c_role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg((r_at + length(r_open))::BIGINT || ':' || (r_at + length(r_open) + length(r_body))::BIGINT, ',' ORDER BY k) FILTER (k >= cut AND r_role = 'assistant'), '') AS rejected_mask
FROM sized GROUP BY conv_id
"""
