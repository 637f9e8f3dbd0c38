"""Corpora as ``(doc_id, source, text)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.sources.positions import with_position

FORMATS = ("parquet", "json", "orc", "text")
BYTES_PER_PARTITION = 64 * 1024 * 1024
UNKNOWN_BYTES = 1 << 55  # an estimate beyond this says that the size is not known


def read_corpus(
    spark: SparkSession,
    path: str | list[str],
    source: str | Column | None = None,
    fmt: str = "parquet",
    text_col: str = "text",
    id_col: str | None = "doc_id",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read documents and check that they have an id and a text.

    ``source`` names the corpus, or is a column of the files that does. Only the
    columns that are used later are read. For ``text`` files every line is a document. Lines have no key: a document's
    id is its position in all files, in path order, the same however files are cut among tasks. So it
    is for other formats with ``id_col=None``.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; known: {', '.join(FORMATS)}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "text":
        docs = with_position(reader.text(path), "doc_id").withColumnRenamed("value", "text")
    else:
        raw = reader.format(fmt).load(path)
        missing = [c for c in (id_col, text_col) if c is not None and c not in raw.columns]
        if missing:
            raise ValueError(f"{path}: no column {', '.join(missing)}")
        if id_col is None:
            used = [c for c in raw.columns if c == text_col or c in _mentioned(source, raw)]
            raw, id_col = with_position(raw.select(used), "_position"), "_position"
        docs = raw.withColumns(
            {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("string")}
        )
    if source is None:
        named = F.col("source") if "source" in docs.columns else F.lit("")
    else:
        named = F.lit(source) if isinstance(source, str) else source
    return docs.select("doc_id", named.cast("string").alias("source"), "text")


def _mentioned(source: str | Column | None, raw: DataFrame) -> list[str]:
    """Columns that the name of the corpus may come from."""
    if source is None:
        return ["source"]
    return [] if isinstance(source, str) else raw.columns


def union_corpora(*corpora: DataFrame) -> DataFrame:
    """Several corpora as one, in the order given, with ids of their own.

    The id of row ``i`` of corpus ``k`` of ``n`` becomes ``i * n + k``: ids of different corpora never
    meet, need no pass over the data and keep the order of each corpus. An id that leaves the range of
    a long stops the job.
    """
    n = len(corpora)
    keyed = [
        docs.withColumn("doc_id", F.col("doc_id").cast("long") * n + k)
        for k, docs in enumerate(corpora)
    ]
    return reduce(lambda left, right: left.unionByName(right), keyed)


def spread(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Repartition only if the input has fewer splits than the session has cores.

    Row-wise work on a large corpus needs no shuffle; a few unsplittable files do.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() >= cores:
        return docs
    return docs.repartition(cores, id_col)


def estimated_bytes(df: DataFrame) -> int:
    """The size by the optimizer's estimate; from ``UNKNOWN_BYTES`` on it is not known."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def by_document(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Partition by document id, so that steps that regroup documents find rows in place.

    The number follows the input's size, ``BYTES_PER_PARTITION`` each by the optimizer's estimate, and is
    not below the session's: work on text is heavy for its bytes, and partitions merged by
    size alone would leave cores idle.
    """
    spark = docs.sparkSession
    size = estimated_bytes(docs)
    wanted = -(-size // BYTES_PER_PARTITION) if size < UNKNOWN_BYTES else 0
    partitions = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
        wanted,
    )
    return docs.repartition(partitions, id_col)
