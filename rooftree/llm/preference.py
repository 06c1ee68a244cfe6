"""Preference pairs from conversations: common prompt once, then two masked completions; DataFrame functions only.

Everything stays one row per turn, so that a conversation with very many turns never meets in one row.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftree.llm.common import staged
from rooftree.operators.skew import ordinal

LAST = (1 << 62)
TRAINED = ("assistant",)


def positions(conversations: DataFrame) -> DataFrame:
    """Distinct turns with their position from 1: by turn (null last), then role and text (null first); null role or text is empty."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.distinct().withColumn("__turn", F.coalesce("turn", F.lit(LAST)))
    order = [F.col("__turn").asc(), F.col("role").asc(), F.col("text").asc()]
    return ordinal(rows, ["conv_id"], order, F.floor(F.col("__turn") / 512), "pos").drop("__turn")


def pair_up(turns: DataFrame) -> DataFrame:
    """Conversations with one first turn, two by two in the order of their ids: (conv_id, pair_id, side).

    The first of two is the chosen one; ``pair_id`` is its id.  A conversation left over is a pair without a rejected side.
    """
    first = turns.where("pos = 1").select("conv_id", F.sha2(F.concat_ws("\x00", "role", "text"), 256).alias("opening"))
    ids = first.withColumn("__id", F.coalesce("conv_id", F.lit(LAST)))
    ranked = ordinal(ids, ["opening"], [F.col("__id").asc()], F.floor(F.col("__id") / 512), "rn")
    ranked = ranked.withColumn("__pair", F.floor((F.col("rn") - 1) / 2))
    lead = ranked.where("rn % 2 = 1").select("opening", "__pair", F.col("conv_id").alias("pair_id"))
    other = ranked.where("rn % 2 = 0").select("opening", "__pair", "conv_id")
    rejected = other.join(lead, ["opening", "__pair"]).select("conv_id", "pair_id", F.lit("rejected").alias("side"))
    return lead.select(F.col("pair_id").alias("conv_id"), "pair_id", F.lit("chosen").alias("side")).unionByName(rejected)


def format_pairs(conversations: DataFrame, pairs: DataFrame | None = None, trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """One row per rendered turn: pair_id, part (prompt, chosen, rejected), pos, role, rendered, loss, prompt_turns, paired.

    The prompt is the longest common prefix of turns (same role and text) of both sides and comes once, from the chosen side.
    ``loss`` is true for the turns of a completion that are trained on; everything else is masked.  ``pairs`` has (conv_id,
    pair_id, side); without it, conversations are paired by ``pair_up``.  A pair without a rejected side has no prompt and
    ``paired`` false.  Null role or text is empty, repeated rows count once, turns with equal numbers are ordered by role and
    text, a null conversation id is one conversation, an empty table gives an empty result, other columns are ignored.
    """
    turns = staged(positions(conversations))
    pairs = staged(pair_up(turns) if pairs is None else pairs)
    both = turns.join(pairs, turns["conv_id"].eqNullSafe(pairs["conv_id"])).select(pairs["pair_id"], "side", "pos", "role", "text")
    sums = both.withColumn("sum", F.sha2(F.concat_ws("\x00", "role", "text"), 256))
    by_pos = sums.groupBy("pair_id", "pos").agg(F.count(F.lit(1)).alias("n"), (F.min("sum") == F.max("sum")).alias("equal"))
    same = (F.col("n") == 2) & F.col("equal")
    prefix = by_pos.groupBy("pair_id").agg(F.coalesce(F.min(F.when(~same, F.col("pos"))) - 1, F.max("pos")).alias("prompt_turns"))
    paired = pairs.groupBy("pair_id").agg((F.count(F.lit(1)) == 2).alias("paired"))
    known = prefix.join(paired, prefix["pair_id"].eqNullSafe(paired["pair_id"])).select(prefix["pair_id"].alias("__pair"), "prompt_turns", "paired")
    rows = both.join(known, both["pair_id"].eqNullSafe(known["__pair"]))
    part = F.when(F.col("pos") <= F.col("prompt_turns"), F.lit("prompt")).otherwise(F.col("side"))
    rows = rows.where((F.col("pos") > F.col("prompt_turns")) | (F.col("side") == "chosen")).withColumn("part", part)
    rendered = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>\n"))
    loss = (F.col("part") != "prompt") & F.col("role").isin(*trained)
    return rows.select("pair_id", "part", "pos", "role", rendered.alias("rendered"), loss.alias("loss"), "prompt_turns", "paired")


SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS body FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, body) AS pos FROM t),
f AS (SELECT conv_id, row_number() OVER (PARTITION BY role, body ORDER BY conv_id) - 1 AS k, role, body FROM p WHERE pos = 1),
q AS (SELECT conv_id, first_value(conv_id) OVER (PARTITION BY role, body, k // 2 ORDER BY k) AS pair_id,
      CASE WHEN k % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side, count(*) OVER (PARTITION BY role, body, k // 2) = 2 AS paired FROM f),
b AS (SELECT q.pair_id, q.side, q.paired, p.pos, p.role, p.body FROM p JOIN q USING (conv_id)),
m AS (SELECT pair_id, pos, count(*) = 2 AND count(DISTINCT (role, body)) = 1 AS same FROM b GROUP BY pair_id, pos),
x AS (SELECT pair_id, coalesce(min(CASE WHEN NOT same THEN pos END) - 1, max(pos)) AS prompt_turns FROM m GROUP BY pair_id)
SELECT pair_id, CASE WHEN pos <= prompt_turns THEN 'prompt' ELSE side END AS part, pos, role,
  '<|' || role || '|>' || chr(10) || body || chr(10) || '<|end|>' || chr(10) AS rendered,
  pos > prompt_turns AND role = 'assistant' AS loss, prompt_turns, paired
FROM b JOIN x USING (pair_id) WHERE pos > prompt_turns OR side = 'chosen'
"""
