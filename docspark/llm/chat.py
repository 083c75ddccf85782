"""Preference formatting of chosen and rejected conversations.

Conversations 2n (chosen) and 2n+1 (rejected) form pair n. Their longest common prefix of
turns is rendered once as the prompt; what follows in each is its completion. A completion's
mask lists its messages as `mask:characters`, mask 1 for assistant messages (trained on) and
0 for the others. Messages render as <|role|>, line feed, text, <|end|>, line feed.

Null roles and texts render as empty strings; a null turn follows every other one; rows with
a null conv_id belong to no pair and are left out. Repeated rows count once; different
messages of one turn are one turn, in order of role and text. A pair with one side missing
has an empty prompt and null for the missing side. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

LAST_TURN = 1 << 62


def preference_pairs(conversations: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """pair_id, prompt, prompt_turns, chosen, chosen_mask, rejected, rejected_mask for conversations (conv_id, turn, role, text)."""
    own = conversations.where("conv_id IS NOT NULL").select(
        F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"), F.pmod(F.col("conv_id"), F.lit(2)).cast("int").alias("side"),
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST_TURN)).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    shown = lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>\n"), m["text"], F.lit("<|end|>\n"))
    messages = own.groupBy("pair_id", "turn", "side").agg(F.sort_array(F.collect_set(F.struct("role", "text"))).alias("m"))
    rendered = messages.select(
        "pair_id", "turn", "side", F.array_join(F.transform("m", shown), "").alias("body"),
        F.array_join(F.transform("m", lambda m: F.concat(F.when(m["role"] == trained_role, "1:").otherwise("0:"), F.length(shown(m)).cast("string"))), ",").alias("mask"),
    )
    of = lambda side, column: F.max(F.when(F.col("side") == side, F.col(column)))
    turns = rendered.groupBy("pair_id", "turn").agg(of(0, "body").alias("c"), of(0, "mask").alias("cm"), of(1, "body").alias("r"), of(1, "mask").alias("rm"))
    pairs = turns.groupBy("pair_id").agg(F.sort_array(F.collect_list(F.struct("turn", "c", "cm", "r", "rm"))).alias("t"), F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("turn"))).alias("apart"))
    before = lambda x: F.col("apart").isNull() | (x["turn"] < F.col("apart"))
    tail = lambda name, glue: F.when(F.exists("t", lambda x: x[name].isNotNull()), F.array_join(F.transform(F.filter("t", lambda x: ~before(x) & x[name].isNotNull()), lambda x: x[name]), glue))
    return pairs.select(
        "pair_id", F.array_join(F.transform(F.filter("t", before), lambda x: x["c"]), "").alias("prompt"), F.size(F.filter("t", before)).cast("long").alias("prompt_turns"),
        tail("c", "").alias("chosen"), tail("cm", ",").alias("chosen_mask"), tail("r", "").alias("rejected"), tail("rm", ",").alias("rejected_mask"),
    )


def op6_chat_formatting(spark, sf_dir: str) -> DataFrame:
    return preference_pairs(table(spark, sf_dir, "conversations"))


OP6_SQL = """
WITH own AS (
  SELECT DISTINCT CAST(floor(conv_id / 2.0) AS BIGINT) AS pair_id, ((conv_id % 2) + 2) % 2 AS side, coalesce(CAST(turn AS BIGINT), 4611686018427387904) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), shown AS (
  SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS body FROM own
), rendered AS (
  SELECT pair_id, turn, side, string_agg(body, '' ORDER BY role, text) AS body, string_agg(CASE WHEN role = 'assistant' THEN '1:' ELSE '0:' END || length(body), ',' ORDER BY role, text) AS mask
  FROM shown GROUP BY ALL
), turns AS (
  SELECT pair_id, turn, max(CASE WHEN side = 0 THEN body END) AS c, max(CASE WHEN side = 0 THEN mask END) AS cm, max(CASE WHEN side = 1 THEN body END) AS r, max(CASE WHEN side = 1 THEN mask END) AS rm
  FROM rendered GROUP BY ALL
), marked AS (
  SELECT *, min(CASE WHEN c IS DISTINCT FROM r THEN turn END) OVER (PARTITION BY pair_id) AS apart FROM turns
)
SELECT pair_id,
  coalesce(string_agg(c, '' ORDER BY turn) FILTER (WHERE apart IS NULL OR turn < apart), '') AS prompt,
  count(*) FILTER (WHERE apart IS NULL OR turn < apart) AS prompt_turns,
  CASE WHEN count(c) > 0 THEN coalesce(string_agg(c, '' ORDER BY turn) FILTER (WHERE turn >= apart), '') END AS chosen,
  CASE WHEN count(c) > 0 THEN coalesce(string_agg(cm, ',' ORDER BY turn) FILTER (WHERE turn >= apart), '') END AS chosen_mask,
  CASE WHEN count(r) > 0 THEN coalesce(string_agg(r, '' ORDER BY turn) FILTER (WHERE turn >= apart), '') END AS rejected,
  CASE WHEN count(r) > 0 THEN coalesce(string_agg(rm, ',' ORDER BY turn) FILTER (WHERE turn >= apart), '') END AS rejected_mask
FROM marked GROUP BY pair_id
"""
