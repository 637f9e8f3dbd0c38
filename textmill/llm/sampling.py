"""Bounded samples that reruns agree on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_hash(rows: DataFrame, key: str, most: int) -> DataFrame:
    """All rows if they have at most ``most`` keys, else those of the keys of the smallest hashes.

    Keys are bounded, not rows: take one row of each by :func:`one_of_each`.

    The cut is a share of the hash range, so no task gathers the sample; its size is ``most`` on
    average and exceeds that by a few times its square root at worst.
    """
    count = rows.select(key).distinct().count()
    if count <= most:
        return rows
    share = int(most / count * (1 << 31))
    return rows.filter(F.pmod(F.xxhash64(F.col(key), F.lit(29)), F.lit(1 << 31)) < share)


def one_of_each(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, text)``: of a key's rows the one whose text has the smallest hash.

    Rows are merged where they are, so a key that holds a third of them is one row for each task.
    """
    least = F.min(F.struct(F.xxhash64(text).alias("h"), F.col(text).alias("t")))["t"]
    return rows.groupBy(key).agg(least.alias(text))
