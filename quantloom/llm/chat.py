"""Operator 1: preference formatting of paired conversations, with DataFrame functions only.

The longest common turn prefix of a chosen and a rejected conversation is rendered once as the prompt; what follows on
either side is rendered as a completion with a mask that marks the assistant's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.jobs import table

HEAD, MIDDLE, TAIL = "<|", "|>\n", "<|end|>\n"


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEAD), t["role"], F.lit(MIDDLE), t["text"], F.lit(TAIL))), "")


def _mask(turns: Column, trained: str) -> Column:
    """Spans (start, end) in characters of the rendered turns that a loss counts: text and tail of the trained role's turns."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans"))

    def add(a: Column, t: Column) -> Column:
        start = a["at"] + F.lit(len(HEAD) + len(MIDDLE)) + F.length(t["role"])
        end = start + F.length(t["text"]) + F.lit(len(TAIL))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == trained, F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    return F.aggregate(turns, begin, add, lambda a: a["spans"])


def format_preferences(
    chosen: DataFrame, rejected: DataFrame, *, pair_col: str = "pair_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trained: str = "assistant",
) -> DataFrame:
    """Prompt and masked completions of each pair; either table holds a row per turn.

    Returns a row per pair that either table names: pair_id, n_common (turns of the longest common prefix), prompt,
    chosen, rejected (the rest of either side), chosen_mask and rejected_mask (spans of the completions, end exclusive)
    and identical (both sides are the same; their completions are empty).

    Turns are ordered by turn (null first), then role and text; a repeated row is a turn of its own. A null role reads
    `unknown`, a null text as empty. A pair that one table lacks has an empty side there and no common turn. Rows
    without a pair id are ignored; empty tables give no rows. Other columns are ignored.

    The only grouping is by pair, whose result holds the pair's text anyhow; conversations that many pairs share are
    never gathered.
    """

    def side(turns: DataFrame, first: bool) -> DataFrame:
        turn = F.struct(F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        return turns.where(F.col(pair_col).isNotNull()).select(F.col(pair_col).cast("long").alias("pair_id"), F.lit(first).alias("first"), turn.alias("t"))

    # collect_list leaves nulls out, so each list holds one side.
    pairs = side(chosen, True).unionByName(side(rejected, False)).groupBy("pair_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("first"), F.col("t")))).alias("c"), F.sort_array(F.collect_list(F.when(~F.col("first"), F.col("t")))).alias("r")
    )
    same = F.zip_with("c", "r", lambda x, y: x.isNotNull() & y.isNotNull() & (x["role"] == y["role"]) & (x["text"] == y["text"]))
    differs = F.array_position(same, F.lit(False))
    pairs = pairs.withColumn("n_common", F.when(differs > 0, differs - 1).otherwise(F.size(same)).cast("int"))
    rest = lambda side: F.slice(side, F.col("n_common") + 1, F.greatest(F.size(side), F.lit(1)))
    pairs = pairs.select("pair_id", F.col("n_common").cast("long").alias("n_common"), F.slice("c", F.lit(1), F.col("n_common")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    return pairs.select(
        "pair_id", "n_common", _rendered(F.col("p")).alias("prompt"), _rendered(F.col("c")).alias("chosen"), _rendered(F.col("r")).alias("rejected"),
        _mask(F.col("c"), trained).alias("chosen_mask"), _mask(F.col("r"), trained).alias("rejected_mask"), ((F.size("c") == 0) & (F.size("r") == 0)).alias("identical"),
    )


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """A rejected side for each conversation: its turns before its last assistant turn, then the last assistant turn of the conversation with the next id, if there is one."""
    last = conversations.where("role = 'assistant' AND conv_id IS NOT NULL").groupBy("conv_id").agg(F.max("turn").alias("last"), F.max_by("text", F.struct("turn", "text")).alias("reply"))
    before = conversations.join(last.select("conv_id", "last"), "conv_id", "left").where("last IS NULL OR turn < last").select("conv_id", "turn", "role", "text")
    donor = last.select((F.col("conv_id") - 1).alias("conv_id"), "reply")
    swapped = last.select("conv_id", "last").join(donor, "conv_id").select("conv_id", F.col("last").alias("turn"), F.lit("assistant").alias("role"), F.col("reply").alias("text"))
    return before.unionByName(swapped)


def op1_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    pairs = format_preferences(conversations, swapped_replies(conversations), pair_col="conv_id")
    spans = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return pairs.select(F.col("pair_id").alias("conv_id"), "n_common", "prompt", "chosen", "rejected", spans("chosen_mask").alias("chosen_mask"), spans("rejected_mask").alias("rejected_mask"), "identical")


OP1_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, max(turn) AS last FROM c WHERE role = 'assistant' GROUP BY conv_id),
a AS (SELECT c.conv_id, c.turn, c.text FROM c JOIN l ON c.conv_id = l.conv_id AND c.turn = l.last AND c.role = 'assistant'),
r AS (
  SELECT c.* FROM c LEFT JOIN l USING (conv_id) WHERE l.last IS NULL OR c.turn < l.last
  UNION ALL SELECT l.conv_id, l.last, 'assistant', d.text FROM l JOIN a d ON d.conv_id = l.conv_id + 1
),
cn AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM c),
rn AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM r),
j AS (SELECT coalesce(cn.conv_id, rn.conv_id) AS conv_id, coalesce(cn.n, rn.n) AS n, coalesce(cn.role = rn.role AND cn.text = rn.text, false) AS same FROM cn FULL JOIN rn ON cn.conv_id = rn.conv_id AND cn.n = rn.n),
k AS (SELECT conv_id, coalesce(min(n) FILTER (NOT same) - 1, count(*)) AS n_common FROM j GROUP BY conv_id),
x AS (
  SELECT s.*, k.n_common, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece FROM (SELECT 'c' AS side, * FROM cn UNION ALL SELECT 'r', * FROM rn) s JOIN k USING (conv_id)
),
m AS (SELECT *, (sum(length(piece)) OVER (PARTITION BY conv_id, side ORDER BY n))::BIGINT AS e FROM x WHERE n > n_common),
f AS (SELECT *, (e - length(text) - 8) || ':' || e AS span FROM m)
SELECT k.conv_id, k.n_common::BIGINT AS n_common,
  coalesce((SELECT string_agg(piece, '' ORDER BY n) FROM x WHERE x.conv_id = k.conv_id AND side = 'c' AND n <= x.n_common), '') AS prompt,
  coalesce((SELECT string_agg(piece, '' ORDER BY n) FROM f WHERE f.conv_id = k.conv_id AND side = 'c'), '') AS chosen,
  coalesce((SELECT string_agg(piece, '' ORDER BY n) FROM f WHERE f.conv_id = k.conv_id AND side = 'r'), '') AS rejected,
  coalesce((SELECT string_agg(span, ',' ORDER BY n) FROM f WHERE f.conv_id = k.conv_id AND side = 'c' AND role = 'assistant'), '') AS chosen_mask,
  coalesce((SELECT string_agg(span, ',' ORDER BY n) FROM f WHERE f.conv_id = k.conv_id AND side = 'r' AND role = 'assistant'), '') AS rejected_mask,
  NOT EXISTS (SELECT 1 FROM f WHERE f.conv_id = k.conv_id) AS identical
FROM k
"""
