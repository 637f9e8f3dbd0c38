"""From raw documents to a training mix: five stages, each written and read again by the next.

Toxic documents go; of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the document
of the smallest id stays; documents with benchmark passages go; personal data is masked; sources are
mixed to their target weights. Each stage works on all rows of the one before and handles null, empty,
repeated and very long texts as its operator says. All but the last return the columns of ``documents``; the last one adds
``size``, ``source_size``, ``target`` and ``taken`` and returns the documents that the mix takes words from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import decontamination, mix, near_dedup, pii
from textmill.llm import toxicity as toxic
from textmill.session import stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxic.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.without_copies(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.masked(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix.mixed(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

#: Trained models and random rounding are in it: compared stage by stage with brute force in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf), name)
    return docs
