"""Lists of strings as newline-joined text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.sources.positions import with_position


def save_text_array(
    array: DataFrame, path: str, value: str = "value", pos: str = "pos"
) -> None:
    """Write the strings in ``pos`` order, one per line, over whatever ``path`` held.

    The part files by number are the array; each is written by its own task.
    A string that holds a line feed comes back as several, and an empty array, whose
    text is empty, as one empty string.
    """
    lines = array.select(F.col(pos), F.coalesce(F.col(value), F.lit("")).alias("value"))
    empty = array.agg(F.count(F.lit(1)) == 0).scalar()
    none = array.sparkSession.range(1).filter(empty).select(
        F.lit(0).cast(lines.schema[pos].dataType).alias(pos), F.lit("").alias("value")
    )
    in_order = lines.unionByName(none).repartitionByRange(F.col(pos)).sortWithinPartitions(pos)
    in_order.select("value").write.mode("overwrite").text(path, lineSep="\n")


def load_text_array(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, value)`` of a directory written by :func:`save_text_array`, any size.

    Files are split among tasks, and the lines stay where they are read.
    """
    return with_position(spark.read.text(path, lineSep="\n"), by_part=True)


def load_text_file(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, value)`` of one file of any size, split at line feeds only.

    Exact to the last character: a closing line feed gives a last empty string and an
    empty file one empty string. Tasks read byte ranges; a line belongs to the one in which it begins. Only
    the file's first three bytes and its last one are looked at here.
    """
    head, last, size = _ends(spark, path)
    lines = with_position(spark.read.text(path, lineSep="\n"))
    if head == _MARK:  # the line reader drops it, a text split at line feeds keeps it
        lines = lines.withColumn("value", F.concat(F.when(F.col("pos") == 0, "\ufeff").otherwise(""), "value"))
    mark_alone = head == _MARK and size == len(_MARK)
    if last not in (b"", b"\n") and not mark_alone:
        return lines
    closing = lines.agg(F.count(F.lit(1)).alias("pos"), F.lit("\ufeff" if mark_alone else "").alias("value"))
    return lines.unionByName(closing)


_MARK = b"\xef\xbb\xbf"


def _ends(spark: SparkSession, path: str) -> tuple[bytes, bytes, int]:
    """A file's first three bytes, its last one and its size."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    size = system.getFileStatus(place).getLen()
    stream = system.open(place)

    def byte() -> bytes:
        value = stream.read()
        return b"" if value < 0 else bytes([value])

    try:
        head = byte() + byte() + byte()
        if size:
            stream.seek(size - 1)
        return head, byte() if size else b"", size
    finally:
        stream.close()
