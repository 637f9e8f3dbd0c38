"""Token ids in two bytes instead of four while they are shuffled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT = 1 << 15


def narrowed(frame: DataFrame, *columns: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The frame with its ``ARRAY<INT>`` columns of that name in two bytes an id, and what gives such columns their type again.

    Ids from 0 to 65,535 fit, as do those of 16 bits with a sign; a column with others, or of another type, stays as it is.
    ``frame`` should be a stored table: its smallest and largest ids are looked for first.
    """
    names = [c for c in columns if frame.schema[c].dataType.simpleString() == "array<int>"]
    if not names:
        return frame, lambda other: other
    ends = [F.struct(F.min(F.array_min(c)), F.max(F.array_max(c))).alias(c) for c in names]
    found = frame.agg(*ends).first()
    shifts = {}
    for c in names:
        low, high = found[c]
        if low is None or -SHORT <= low and high < SHORT:
            shifts[c] = 0
        elif 0 <= low and high < 2 * SHORT:
            shifts[c] = SHORT

    def short(c: str, shift: int) -> Column:
        ids = F.transform(c, lambda i: i - F.lit(shift)) if shift else F.col(c)
        return ids.cast("array<smallint>")

    def long(c: str, shift: int) -> Column:
        ids = F.col(c).cast("array<int>")
        return F.transform(ids, lambda i: i + F.lit(shift)) if shift else ids

    def widened(other: DataFrame) -> DataFrame:
        return other.withColumns({c: long(c, shift) for c, shift in shifts.items() if c in other.columns})

    return frame.withColumns({c: short(c, shift) for c, shift in shifts.items()}), widened
