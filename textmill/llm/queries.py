"""One query per operator of this package, over whole tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import (
    chat_rotation,
    conversation_repair,
    decontamination,
    hard_negatives,
    html_template,
    mix,
    near_dedup,
    packing,
    pii,
    quality_rules,
    token_counts,
    toxicity,
    warc_fixity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.report(_table(spark, sf, "documents"))


@query
def op2_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_template.extract(_table(spark, sf, "pages"))


@query
def op3_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mix.report(_table(spark, sf, "documents"))


@query
def op4_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.clustered(_table(spark, sf, "documents"), shingle=3, percent=85)


@query
def op5_chat_rotation(spark: SparkSession, sf: str) -> DataFrame:
    return chat_rotation.rotated(_table(spark, sf, "conversations"))


@query
def op6_warc_fixity(spark: SparkSession, sf: str) -> DataFrame:
    return warc_fixity.report(_table(spark, sf, "pages"))


@query
def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.report(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@query
def op9_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.report(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


@query
def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.report(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@query
def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_repair.report(_table(spark, sf, "conversations"))


@query
def op12_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return packing.report(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return hard_negatives.report(_table(spark, sf, "embeddings"))


SQL["op11_conversation_repair"] = conversation_repair.SQL
SQL["op13_hard_negatives"] = hard_negatives.SQL
SQL["op4_near_dedup"] = near_dedup.SQL
SQL["op9_benchmark_decontamination"] = decontamination.SQL
SQL["op5_chat_rotation"] = chat_rotation.SQL
SQL["op6_warc_fixity"] = warc_fixity.SQL
