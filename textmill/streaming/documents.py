"""The row-wise steps on arriving documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from textmill import tables
from textmill.operators import layout
from textmill.plans import prepare

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def clean_arrivals(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    ratio: float = tables.VALIDATION_RATIO,
    seed: int | str = 0,
    **cleaning,
) -> DataFrame:
    """Documents that arrive as files, cleaned and split by hash. Keeps no state."""
    arriving = spark.readStream.schema(DOCUMENT_SCHEMA).format(fmt).load(path)
    return layout.hash_split(prepare.clean_documents(arriving, **cleaning), ratio, seed)


def append_to(cleaned: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append each batch to a table, one folder per split."""
    return (
        cleaned.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("split")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
