"""Building a vocabulary in one aggregate, and looking pieces up in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill import tables
from textmill.functions import control
from textmill.functions import pieces as P

BYTES = 256
BROADCAST_BYTES = 256 * 1024 * 1024


def piece_counts(
    docs: DataFrame, text: str = "text", pattern: str = "gpt2", family: str = "tiktoken"
) -> DataFrame:
    """How often each piece occurs, control tokens of ``family`` left out.

    The text is cut as encoding cuts it. Counting starts before the shuffle, so a piece
    that makes up most of the text costs no more than a rare one.
    """
    cut = P.split_pieces_with_control(F.col(text), pattern, family)
    return (
        docs.select(F.explode(cut).alias("piece"))
        .filter(~F.col("piece").isin(*control.spelling(family).values()))
        .groupBy("piece")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def _least(counts: DataFrame, room: int) -> int:
    """A frequency that at least ``room`` pieces reach, and not many more: by counts per eighth of a doubling."""
    step = F.floor(F.log2("occurrences") * 8).cast("int")
    sizes = counts.filter("occurrences > 0").groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("occurrences").alias("least"))
    total = 0
    for r in sorted(sizes.collect(), key=lambda r: -r.step):
        total += r.n
        if total >= room:
            return r.least
    return 0


def build_vocabulary(
    counts: DataFrame,
    size: int = tables.VOCABULARY_SIZE,
    max_bytes: int = tables.MAX_TOKEN_BYTES,
    forced: Sequence[str] = tuple(tables.FORCED_TOKENS),
) -> DataFrame:
    """The most frequent pieces with their ids: ``(piece, occurrences, id)``.

    Ids 0 to 255 are the bytes, then come the pieces by frequency, and the control
    tokens close the ``size`` ids. Forced pieces are always in. Counts of frequencies tell which
    frequency is needed at least, so that little more than the wanted number of rows is ranked. ``counts``
    is read several times: give it stored.
    """
    room = size - BYTES - len(tables.READABLE_CONTROL)
    if room < len(forced):
        raise ValueError(f"a vocabulary of {size} ids has no room for pieces")
    short = counts.filter(F.octet_length("piece") <= max_bytes)
    names = F.array(*[F.lit(f) for f in forced]).cast("array<string>")
    best = [
        F.when(F.array_contains(names, F.col("piece")), 0).otherwise(1),
        F.desc("occurrences"),
        F.col("piece"),
    ]
    kept = short.filter((F.col("occurrences") >= _least(short, room)) | (best[0] == 0))
    chosen = kept.orderBy(*best).limit(room)
    if forced:
        # at most `room` rows: add the forced pieces that do not occur, rank once more
        never = counts.sparkSession.range(1).select(
            F.explode(names).alias("piece"), F.lit(0).cast("long").alias("occurrences")
        )
        both = chosen.unionByName(never).groupBy("piece")
        chosen = both.agg(F.sum("occurrences").alias("occurrences")).orderBy(*best).limit(room)
    rank = F.row_number().over(Window.orderBy(F.desc("occurrences"), "piece"))
    return chosen.select("piece", "occurrences", (rank + (BYTES - 1)).cast("int").alias("id"))


def control_start(size: int = tables.VOCABULARY_SIZE) -> int:
    """Id of the first control token of a vocabulary of ``size`` ids."""
    return size - len(tables.READABLE_CONTROL)


def checked_broadcast(
    table: DataFrame, size: Column, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """The table, marked for broadcast if the sum of ``size`` over its rows allows it.

    The sum is taken from the data before the mark is set. Beyond the limit the table is
    returned as it is and joins on it shuffle.
    """
    measured = table.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(table) if measured <= limit else table


def id_width(tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """Largest id and the narrowest unsigned type that holds it."""
    largest = tokens.agg(
        F.coalesce(F.max(F.array_max(column)), F.lit(0)).alias("max_id")
    )
    return largest.withColumn(
        "dtype", F.when(F.col("max_id") < 2**16, "uint16").otherwise("uint32")
    )
