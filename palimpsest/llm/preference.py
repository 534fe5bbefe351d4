"""Preference formatting: one prompt from the turns that a chosen and a rejected conversation begin with, and two completions.

Only built-in functions run here: turns meet their pair in one shuffle, after which windows and aggregations need none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"
TRAINED_ROLE = "assistant"


def preference_pairs(turns: DataFrame, pair: Column, chosen: Column, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a pair: pair_id, chosen_id, rejected_id, n_prompt_turns, prompt, and for each side its completion and spans.

    pair gives a turn's pair, chosen whether its conversation is the preferred one. The prompt is the longest run of first
    turns equal in role and text on both sides. The rest of a side is its completion; spans "start-end,..." (code points
    of the completion, end not included) hold texts and end marks of the assistant's turns, which alone are trained on.

    Turns stand by turn number, ties by role, then text; null numbers come first, null roles and texts are empty. Repeated
    rows are turns of their own. A side without a conversation has null id, completion and spans, and the prompt is empty
    then; two equal conversations have empty completions. Rows whose pair is null are left out. More columns don't matter.
    """
    rows = turns.select(
        pair.cast("long").alias("pair_id"),
        F.when(chosen, 0).otherwise(1).alias("_side"),
        F.col(conv_col).alias("_conv"),
        F.col(turn_col).alias("_turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("_role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    ).where("pair_id IS NOT NULL")
    side = Window.partitionBy("pair_id", "_side").orderBy("_turn", "_role", "_text")
    placed = rows.repartition("pair_id").withColumn("_at", F.row_number().over(side))
    both = Window.partitionBy("pair_id", "_at")
    turn = F.struct("_role", "_text")
    equal = (F.count(F.lit(1)).over(both) == 2) & (F.min(turn).over(both) == F.max(turn).over(both))
    marked = placed.withColumn("_equal", equal)
    first = F.min(F.when(~F.col("_equal"), F.col("_at"))).over(Window.partitionBy("pair_id"))
    shared = marked.withColumn("_shared", F.coalesce(F.col("_at") < first, F.lit(True)))
    head = F.concat(F.lit(OPEN), "_role", F.lit(MIDDLE))
    rendered = shared.withColumn("_piece", F.concat(head, "_text", F.lit(CLOSE))).withColumn("_length", F.when(F.col("_shared"), 0).otherwise(F.length("_piece")))
    end = F.sum("_length").over(Window.partitionBy("pair_id", "_side").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    spanned = rendered.withColumn("_end", end).withColumn("_start", F.col("_end") - F.length("_text") - F.lit(len(CLOSE)))

    def joined(where: Column, what: Column, by: str) -> Column:
        found = F.array_sort(F.collect_list(F.when(where, F.struct("_at", what.alias("_what")))))
        return F.array_join(F.transform(found, lambda x: x["_what"]), by)

    span = F.concat(F.col("_start").cast("string"), F.lit("-"), F.col("_end").cast("string"))
    columns = [F.count_if(F.col("_shared") & (F.col("_side") == 0)).alias("n_prompt_turns"), joined(F.col("_shared") & (F.col("_side") == 0), F.col("_piece"), "").alias("prompt")]
    for k, name in enumerate(("chosen", "rejected")):
        own = (F.col("_side") == k) & ~F.col("_shared")
        there = F.count_if(F.col("_side") == k) > 0
        columns.append(F.max(F.when(F.col("_side") == k, F.col("_conv"))).alias(f"{name}_id"))
        columns.append(F.when(there, joined(own, F.col("_piece"), "")).alias(name))
        columns.append(F.when(there, joined(own & (F.col("_role") == TRAINED_ROLE), span, ",")).alias(f"{name}_spans"))
    out = spanned.groupBy("pair_id").agg(*columns)
    return out.select("pair_id", "chosen_id", "rejected_id", "n_prompt_turns", "prompt", "chosen", "chosen_spans", "rejected", "rejected_spans")


def op9_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) make pair k."""
    turns = table(spark, sf_dir, "conversations")
    return preference_pairs(turns, F.floor(F.col("conv_id") / 2), F.pmod("conv_id", F.lit(2)) == 0)


OP9_SQL = """
WITH turns AS (
  SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, CASE WHEN conv_id % 2 = 0 THEN 0 ELSE 1 END AS side, conv_id,
         coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
marked AS (
  SELECT *, count(*) OVER w = 2 AND min(role) OVER w = max(role) OVER w AND min(text) OVER w = max(text) OVER w AS eq
  FROM turns WINDOW w AS (PARTITION BY pair_id, pos)),
shared AS (
  SELECT *, coalesce(pos < min(CASE WHEN NOT eq THEN pos END) OVER (PARTITION BY pair_id), true) AS shared,
         '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece FROM marked),
placed AS (
  SELECT *, sum(CASE WHEN shared THEN 0 ELSE length(piece) END) OVER (PARTITION BY pair_id, side ORDER BY pos) AS e FROM shared),
spans AS (SELECT *, CAST(e - length(text) - 8 AS BIGINT) || '-' || CAST(e AS BIGINT) AS span FROM placed)
SELECT pair_id,
  max(CASE WHEN side = 0 THEN conv_id END) AS chosen_id,
  max(CASE WHEN side = 1 THEN conv_id END) AS rejected_id,
  count(*) FILTER (WHERE shared AND side = 0) AS n_prompt_turns,
  coalesce(string_agg(piece, '' ORDER BY pos) FILTER (WHERE shared AND side = 0), '') AS prompt,
  CASE WHEN count(*) FILTER (WHERE side = 0) > 0 THEN coalesce(string_agg(piece, '' ORDER BY pos) FILTER (WHERE side = 0 AND NOT shared), '') END AS chosen,
  CASE WHEN count(*) FILTER (WHERE side = 0) > 0 THEN coalesce(string_agg(span, ',' ORDER BY pos) FILTER (WHERE side = 0 AND NOT shared AND role = 'assistant'), '') END AS chosen_spans,
  CASE WHEN count(*) FILTER (WHERE side = 1) > 0 THEN coalesce(string_agg(piece, '' ORDER BY pos) FILTER (WHERE side = 1 AND NOT shared), '') END AS rejected,
  CASE WHEN count(*) FILTER (WHERE side = 1) > 0 THEN coalesce(string_agg(span, ',' ORDER BY pos) FILTER (WHERE side = 1 AND NOT shared AND role = 'assistant'), '') END AS rejected_spans
FROM spans GROUP BY pair_id
"""
