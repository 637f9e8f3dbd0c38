"""Running totals and row numbers over a global order, without a global sort task.

Each ordered group is cut into buckets that follow the order. Totals per bucket are a
small aggregate; running them gives every bucket its starting value; inside a bucket
an ordinary window finishes the job. No task ever holds more than one bucket, so a
group that owns most of the rows is spread like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 65_536
SPLIT_BITS = 8
ROWS_PER_BUCKET = 250_000


def range_bounds(
    df: DataFrame, key: str, rows_per_bucket: int = ROWS_PER_BUCKET, weight: Column | None = None
) -> list[int]:
    """Values of an integer column that cut it into buckets of about ``rows_per_bucket`` rows, or that sum of ``weight``.

    Rows are counted per cell of equal width, by an ordinary aggregate of at most ``CELLS`` groups;
    only cells with more rows than a bucket are counted again in ``2 ** SPLIT_BITS`` parts, until none is
    left or a cell is one value. No task gets more than such counts.
    """
    if weight is None:
        weight = F.lit(1)
    df = df.select(key, weight.cast("long").alias("_weight")).filter(F.col(key).isNotNull())
    low, high, rows = df.agg(F.min(key), F.max(key), F.sum("_weight")).first()
    if not rows or rows <= rows_per_bucket:
        return []
    bits = max(0, ((high - low) // CELLS).bit_length())

    def cell(bits: int) -> Column:
        """Number of a value's cell; cells of fewer bits lie inside those of more."""
        return F.shiftright(F.col(key).cast("long"), bits)

    inside, counts = df, {}
    while True:
        found = inside.groupBy(cell(bits).alias("cell")).agg(F.sum("_weight").alias("count")).collect()
        heavy = [r.cell for r in found if r["count"] > rows_per_bucket] if bits else []
        again = set(heavy)
        counts |= {r.cell << bits: r["count"] for r in found if r.cell not in again}
        if not heavy:
            break
        # no more cells than there are full buckets
        table = df.sparkSession.createDataFrame([(c,) for c in heavy], "heavy long")
        inside = df.join(F.broadcast(table), cell(bits) == F.col("heavy")).drop("heavy")
        bits = max(0, bits - SPLIT_BITS)
    bounds, held = [], 0
    for start in sorted(counts):
        if held and held + counts[start] > rows_per_bucket:
            bounds.append(start)
            held = 0
        held += counts[start]
    return bounds


def with_range_bucket(
    df: DataFrame,
    key: str,
    bucket: str = "bucket",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    weight: Column | None = None,
) -> DataFrame:
    """Add a bucket number that never falls as ``key`` (an integer column) rises.

    The bounds are fixed before the column is made, so every use of the result sees the same buckets, also
    when tasks are run again. There are as many buckets as the rows need. A null key is in bucket 0. With ``weight`` a
    bucket has about ``rows_per_bucket`` of its sum.
    """
    bounds = range_bounds(df, key, rows_per_bucket, weight)
    if not bounds:
        return df.withColumn(bucket, F.lit(0))
    splits = [float("-inf"), *map(float, sorted({float(b) for b in bounds})), float("inf")]
    keyed = df.withColumn("_bucket_key", F.coalesce(F.col(key).cast("double"), F.lit(float("-inf"))))
    numbered = Bucketizer(
        splits=splits, inputCol="_bucket_key", outputCol="_bucket_number"
    ).transform(keyed)
    return numbered.withColumn(bucket, F.col("_bucket_number").cast("int")).drop(
        "_bucket_key", "_bucket_number"
    )


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on ``keys`` where null equals null, so that no row is lost; keys of ``left`` stay."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def running_totals(
    df: DataFrame,
    totals: Mapping[str, Column],
    order: Sequence[str],
    bucket: str,
    within: Sequence[str] = (),
    few_buckets: bool = False,
) -> DataFrame:
    """Add, for each name in ``totals``, the sum of its value over all earlier rows.

    ``bucket`` must not fall along ``order`` inside a ``within`` group. Starting values are
    a first row of each bucket, so the rows are shuffled once and joined with nothing. With
    ``few_buckets`` the caller vouches that buckets times groups is a small number
    that does not grow with the data, and the starting values are broadcast.
    """
    keys = [*within, bucket]
    values = {name: f"_{name}_value" for name in totals}
    valued = df.withColumns({values[name]: value for name, value in totals.items()})
    sums = valued.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values.values()])
    # one row per bucket
    earlier = Window.partitionBy(*within).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sums.select(
        *keys,
        *[
            F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_{name}_start")
            for name, v in values.items()
        ],
    )
    if not few_buckets:
        opening = starts.select(
            *keys, F.lit(0).alias("_later"), *[F.col(f"_{name}_start").alias(v) for name, v in values.items()]
        )
        both = valued.withColumn("_later", F.lit(1)).unionByName(opening, allowMissingColumns=True)
        earlier = Window.partitionBy(*keys).orderBy("_later", *order).rowsBetween(
            Window.unboundedPreceding, -1
        )
        summed = both.withColumns({name: F.sum(v).over(earlier) for name, v in values.items()})
        return summed.filter("_later = 1").select(*df.columns, *totals)
    joined = null_safe_join(valued, F.broadcast(starts), keys)
    before = (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    out = joined.withColumns(
        {
            name: F.col(f"_{name}_start") + F.coalesce(F.sum(v).over(before), F.lit(0))
            for name, v in values.items()
        }
    )
    return out.select(*df.columns, *totals)


def row_index(
    df: DataFrame,
    order: Sequence[str],
    bucket: str,
    within: Sequence[str] = (),
    name: str = "row_index",
    few_buckets: bool = False,
) -> DataFrame:
    """Add the position of each row, from 0, inside its group."""
    return running_totals(df, {name: F.lit(1)}, order, bucket, within, few_buckets)


def hash_key(*parts: Column | str, seed: int | str) -> Column:
    """A text key that orders rows at random but always alike: md5 of parts and seed."""
    columns = [p if isinstance(p, Column) else F.col(p) for p in parts]
    return F.md5(
        F.concat_ws("-", *[c.cast("string") for c in columns], F.lit(str(seed)))
        .cast("binary")
    )


def hash_fraction(key: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of a :func:`hash_key`."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long") / F.lit(float(2**32))


def hash_bucket(key: Column, digits: int = 3) -> Column:
    """Bucket of a :func:`hash_key` that follows its order; ``16 ** digits`` of them."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("int")
