"""Conversations as text with role tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import control
from textmill.operators.ordering import null_safe_join

ROLES = ("system", "user", "assistant", "human")
#: Turn numbers whose texts are put together in one task before the conversation is.
STRETCH = 256


def role_token(role: Column, family: str = "tiktoken") -> Column:
    """Control token of a role; the unknown token for any other role."""
    token = control.spelling(family)
    found = F.lit(token["unknown"])
    for name in ROLES:
        found = F.when(role == name, F.lit(token[name])).otherwise(found)
    return found


def render_conversations(
    turns: DataFrame,
    family: str = "tiktoken",
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    turns_per_part: int | None = None,
) -> DataFrame:
    """Role token and text of each turn in turn order: ``(conversation, part, text)``.

    One row per conversation, part 0, whatever its length or turn numbers, with the start token before
    and the end token after it: stretches of turns become text first, then the stretches in
    order. Turns of equal number are ordered by their text, a null number comes first.

    Only with ``turns_per_part`` a conversation comes in parts, cut where the turn number is a
    multiple of it; the parts in order are the conversation.
    """
    token = control.spelling(family)
    spoken = F.concat(role_token(F.col(role), family), F.coalesce(F.col(text), F.lit("")))

    def in_order(place: str, value: Column) -> Column:
        listed = F.sort_array(F.collect_list(F.struct(F.col(place), value.alias("t"))))
        return F.concat_ws("", listed["t"])

    stretch = F.floor(F.col(turn) / (turns_per_part or STRETCH))
    stretches = (
        turns.withColumn("_stretch", stretch)
        .groupBy(conversation, "_stretch")
        .agg(in_order(turn, spoken).alias("_text"))
    )
    start, end = F.lit(token["start_of_text"]), F.lit(token["end_of_text"])
    if turns_per_part is None:
        whole = F.concat(start, in_order("_stretch", F.col("_text")), end)
        return stretches.groupBy(conversation).agg(F.lit(0).alias("part"), whole.alias("text"))
    ends = turns.groupBy(conversation).agg(
        F.min(stretch).alias("_first"), F.max(stretch).alias("_last")
    )
    parts = null_safe_join(stretches, ends, [conversation])
    opening = F.when(F.col("_stretch").eqNullSafe(F.col("_first")), start).otherwise("")
    closing = F.when(F.col("_stretch").eqNullSafe(F.col("_last")), end).otherwise("")
    return parts.select(
        conversation,
        (F.col("_stretch") - F.col("_first")).cast("int").alias("part"),
        F.concat(opening, "_text", closing).alias("text"),
    )
