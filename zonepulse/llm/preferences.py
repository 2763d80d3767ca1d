"""Preference formatting: pairs of conversations as one shared prompt and two masked completions, in DataFrame operations only.

The turns of the chosen and of the rejected conversation of a pair meet on (pair, turn number). The least number at
which they differ ends the prompt. Every turn is rendered once on its own; what stands after the prompt carries spans that say
which characters count for training: those that the assistant wrote. Conversations of any length are split into blocks of
turn numbers, so no row and no group grows with a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turn numbers in a block.
BLOCK = 256


def _rendered(role: str, text: str) -> tuple[Column, Column]:
    """A turn's heading and its whole text in the training format."""
    head = F.concat(F.lit("<|"), F.col(role), F.lit("|>\n"))
    return head, F.concat(head, F.col(text), F.lit("\n<|end|>\n"))


def preference_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair_id, block, first_difference, prompt, chosen, rejected, chosen_spans, rejected_spans).

    ``turns``: (conv_id, turn, role, text); ``pairs``: (pair_id, chosen_id, rejected_id). One row per pair and block of 256 turn
    numbers, blocks without turns left out; rows of a pair joined in block order give its whole prompt and completions. A
    span is start+length, in characters of that row's completion, of the text an assistant wrote; spans are parted by spaces.

    Turns at one number that are equal in role and text count once; several different ones stand in the order of role and text
    and are compared as a whole. A null role is "unknown", a null text empty. Rows without conv_id or turn belong to no
    conversation. A pair with an equal, or a missing, second conversation: first_difference is null where all turns agree (all is prompt),
    else the first turn that only one has. A repeated row of ``pairs`` changes nothing; several rows of one pair_id with
    different conversations put their turns together on either side. Other columns are ignored.
    """
    clean = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).distinct()
    sides = pairs.select("pair_id", F.expr("stack(2, 'chosen', chosen_id, 'rejected', rejected_id) AS (side, conv_id)"))
    # One row per turn of a pair, with the sides that have it; repeated pairs fall together.
    has = lambda side: F.max(F.col("side") == side)
    met = clean.join(sides, "conv_id").groupBy("pair_id", "turn", "role", "text").agg(has("chosen").alias("c"), has("rejected").alias("r"))
    # A turn of one side only, or one whose rows differ, ends the common prefix.
    first = met.groupBy("pair_id").agg(F.min(F.when(~(F.col("c") & F.col("r")), F.col("turn"))).alias("first_difference"))
    placed = met.join(first, "pair_id")
    # The prompt is rendered once; after it a turn goes to each side that has it.
    shared = F.col("first_difference").isNull() | (F.col("turn") < F.col("first_difference"))
    parts = F.when(shared, F.array(F.lit("prompt"))).otherwise(F.array_compact(F.array(F.when(F.col("c"), F.lit("chosen")), F.when(F.col("r"), F.lit("rejected")))))
    placed = placed.select("pair_id", "turn", "role", "text", "first_difference", F.explode(parts).alias("part"), F.floor(F.col("turn") / BLOCK).alias("block"))
    head, whole = _rendered("role", "text")
    group = Window.partitionBy("pair_id", "block", "part").orderBy("turn", "role", "text")
    cut = placed.withColumn("whole", whole).withColumn("skip", F.char_length(head))
    cut = cut.withColumn("before", F.coalesce(F.sum(F.char_length("whole")).over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    span = F.when(F.col("role") == "assistant", F.concat((F.col("before") + F.col("skip")).cast("string"), F.lit("+"), F.char_length("text").cast("string")))
    rows = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "whole", span.alias("span"))))
    blocks = cut.groupBy("pair_id", "block", "part", "first_difference").agg(rows.alias("rows"))
    text = lambda part: F.coalesce(F.max(F.when(F.col("part") == part, F.array_join("rows.whole", ""))), F.lit(""))
    spans = lambda part: F.coalesce(F.max(F.when(F.col("part") == part, F.array_join("rows.span", " "))), F.lit(""))
    return blocks.groupBy("pair_id", "block", "first_difference").agg(
        text("prompt").alias("prompt"), text("chosen").alias("chosen"), text("rejected").alias("rejected"),
        spans("chosen").alias("chosen_spans"), spans("rejected").alias("rejected_spans"),
    )


def neighbouring_pairs(turns: DataFrame) -> DataFrame:
    """Pairs each even conversation (chosen) with the odd one after it (rejected); one alone has no second."""
    ids = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    even = F.pmod("conv_id", F.lit(2)) == 0
    return ids.groupBy(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id")).agg(
        F.min(F.when(even, F.col("conv_id"))).alias("chosen_id"), F.min(F.when(~even, F.col("conv_id"))).alias("rejected_id")
    )


#: DuckDB SQL for preference_pairs over neighbouring_pairs.
SQL = """
WITH clean AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
met AS (
  SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, CASE WHEN conv_id % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side, turn, role, text FROM clean),
one AS (SELECT pair_id, turn, role, text, count(*) AS sides FROM met GROUP BY ALL),
diff AS (SELECT pair_id, min(CASE WHEN sides < 2 THEN turn END) AS first_difference FROM one GROUP BY pair_id),
placed AS (
  SELECT met.*, first_difference, CAST(floor(turn / 256) AS BIGINT) AS block,
    CASE WHEN first_difference IS NULL OR turn < first_difference THEN 'prompt' ELSE side END AS part
  FROM met JOIN diff USING (pair_id)),
cut AS (
  SELECT *, '<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS whole, length(role) + 5 AS skip
  FROM placed WHERE part != 'prompt' OR side = 'chosen'),
spanned AS (
  SELECT *, CASE WHEN role = 'assistant' THEN CAST(coalesce(sum(length(whole)) OVER (PARTITION BY pair_id, block, part ORDER BY turn, role, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + skip AS BIGINT) || '+' || length(text) END AS span FROM cut)
SELECT pair_id, block, first_difference,
  coalesce(string_agg(whole, '' ORDER BY turn, role, text) FILTER (part = 'prompt'), '') AS prompt,
  coalesce(string_agg(whole, '' ORDER BY turn, role, text) FILTER (part = 'chosen'), '') AS chosen,
  coalesce(string_agg(whole, '' ORDER BY turn, role, text) FILTER (part = 'rejected'), '') AS rejected,
  coalesce(string_agg(span, ' ' ORDER BY turn, role, text) FILTER (part = 'chosen'), '') AS chosen_spans,
  coalesce(string_agg(span, ' ' ORDER BY turn, role, text) FILTER (part = 'rejected'), '') AS rejected_spans
FROM spanned GROUP BY pair_id, block, first_difference
"""
