"""Multi-party perspective rotation of conversations.

For every participant of a conversation the whole dialogue is rendered with that participant as the
assistant and all others as named users. The result has one row for each perspective and turn: the turn's text with
its marks, its place in the rendered dialogue in characters, and whether it is learned from. The rows of a
perspective in order, put together, are the dialogue. So no row and no group grows with the length of
a conversation: places are running sums in two levels, over stretches of ``STRETCH`` turn numbers
and inside each.

Turns are ordered by turn number, role and text; a null number comes first. A null role speaks as ``unknown``; a null text
is empty. Equal turns are all kept. A null conversation is one of its own. An empty table gives an
empty result. Other columns are not read. Column expressions, joins and windows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import stored

STRETCH = 256
UNKNOWN = "unknown"
END = "<|end|>\n"


def opening(speaker: Column, perspective: Column) -> Column:
    """Mark before a turn: of the assistant, or of a user by name."""
    return F.when(speaker == perspective, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user|>"), speaker, F.lit("\n")))


def rotated(turns: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """``(conv_id, perspective, turn, position, speaker, learned, segment, first, last)``.

    ``first`` and ``last`` (exclusive) bound the turn's text and end mark in the rendered dialogue: what is learned
    from if ``learned``.
    """
    said = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / stretch), F.lit(-(1 << 60))).cast("long").alias("stretch"),
    )
    order = Window.partitionBy("conv_id", "stretch").orderBy(F.col("turn").asc_nulls_first(), "speaker", "text")
    said = stored(said.withColumn("nth", F.row_number().over(order)), "turns")
    # places need lengths only: no text is multiplied before its place is known
    narrow = said.select("conv_id", "stretch", "nth", "speaker", F.length("text").cast("long").alias("chars"))
    who = said.select(F.col("conv_id").alias("_c"), F.col("speaker").alias("perspective")).distinct()
    size = F.length(opening(F.col("speaker"), F.col("perspective"))) + F.col("chars") + len(END)
    rows = narrow.join(who, F.col("conv_id").eqNullSafe(F.col("_c"))).select(
        "conv_id", "perspective", "stretch", "nth", "chars", size.cast("long").alias("size")
    )
    key = ["conv_id", "perspective"]
    sums = rows.groupBy(*key, "stretch").agg(F.sum("size").alias("chars"), F.count("*").alias("turns"))
    earlier = Window.partitionBy(*key).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        F.col("conv_id").alias("_c"),
        F.col("perspective").alias("_p"),
        F.col("stretch").alias("_s"),
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns_before"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("perspective") == F.col("_p")) & (F.col("stretch") == F.col("_s"))
    through = Window.partitionBy(*key, "stretch").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.col("chars_before") + F.sum("size").over(through)
    placed = rows.join(before, same).select(
        F.col("conv_id").alias("_c"),
        "perspective",
        F.col("stretch").alias("_s"),
        F.col("nth").alias("_n"),
        (F.col("turns_before") + F.col("nth") - 1).alias("position"),
        (last - F.col("chars") - len(END)).alias("first"),
        last.alias("last"),
    )
    again = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("stretch") == F.col("_s")) & (F.col("nth") == F.col("_n"))
    return said.join(placed, again).select(
        *key,
        "turn",
        "position",
        "speaker",
        (F.col("speaker") == F.col("perspective")).alias("learned"),
        F.concat(opening(F.col("speaker"), F.col("perspective")), F.col("text"), F.lit(END)).alias("segment"),
        "first",
        "last",
    )


SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '{UNKNOWN}') AS speaker, coalesce(text, '') AS text FROM conversations
), rows AS (
  SELECT s.*, w.speaker AS perspective,
    CASE WHEN s.speaker = w.speaker THEN '<|assistant|>' || chr(10) ELSE '<|user|>' || s.speaker || chr(10) END AS mark
  FROM said s JOIN (SELECT DISTINCT conv_id, speaker FROM said) w ON s.conv_id IS NOT DISTINCT FROM w.conv_id
), placed AS (
  SELECT *, row_number() OVER w - 1 AS position,
    sum(length(mark) + length(text) + {len(END)}) OVER (w ROWS UNBOUNDED PRECEDING) AS last
  FROM rows WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text)
)
SELECT conv_id, perspective, turn, position, speaker, speaker = perspective AS learned,
  mark || text || '<|end|>' || chr(10) AS segment,
  CAST(last - length(text) - {len(END)} AS BIGINT) AS first, CAST(last AS BIGINT) AS last
FROM placed
"""
