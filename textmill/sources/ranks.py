"""Rank tables: lines of ``base64(token) rank``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """``(token BINARY, id INT)`` from a text file of ranks."""
    fields = F.split("value", " ")
    return (
        spark.read.text(path)
        .filter("value != ''")
        .select(F.unbase64(fields[0]).alias("token"), fields[1].cast("int").alias("id"))
    )


def write_ranks(ranks: DataFrame, path: str) -> None:
    """The same format, in id order."""
    lines = ranks.repartitionByRange("id").sortWithinPartitions("id")
    # base64() breaks its output into lines
    spelled = F.regexp_replace(F.base64("token"), r"\s", "")
    lines.select(F.concat_ws(" ", spelled, F.col("id").cast("string"))).write.mode(
        "overwrite"
    ).text(path)
