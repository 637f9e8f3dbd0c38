"""Positions of rows in the files that they are read from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators import ordering
from textmill.session import stored


def with_position(read: DataFrame, name: str = "pos", by_part: bool = False) -> DataFrame:
    """Add each row's place, from 0, in all files together: files in path order, rows as they stand.

    ``read`` must come straight from a file reader, nothing but projected. The rows stay where they are read: a
    row's place is its number in the part of a file that a task reads, plus the rows of all parts before. Only those
    counts are ordered, one for each part, in two levels. However files are cut among tasks, and however
    often they are read, a row has the same place. ``by_part`` orders files by the number in ``part-<number>``.
    """
    held = read.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    parts = held.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    number = F.regexp_extract("_file", r"part-(\d+)[^/]*$", 1).try_cast("long") if by_part else F.lit(0).cast("long")
    order = ["_number", "_file", "_block"]
    # as many stretches as the parts need, each in the order of all
    dealt = parts.withColumn("_number", number).repartitionByRange(*order)
    numbered = stored(dealt.withColumn("_stretch", F.spark_partition_id()), "parts")
    starts = ordering.running_totals(numbered, {"_before": F.col("_n")}, order=order, bucket="_stretch").select(
        "_file", "_block", "_first", "_before"
    )
    place = F.col("_before") + F.col("_row") - F.col("_first")
    joined = held.join(starts, ["_file", "_block"])
    return joined.select(place.cast("long").alias(name), *[F.col(c) for c in read.columns])
