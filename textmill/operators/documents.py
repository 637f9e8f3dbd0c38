"""Picking, filtering and wrapping documents; the character audit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill import tables
from textmill.functions import charsets, cleaning, control
from textmill.operators import ordering


def min_size(
    docs: DataFrame, size: int = tables.MIN_DOCUMENT_SIZE, text: str = "text"
) -> DataFrame:
    """Keep documents of at least ``size`` characters, outer white space not counted.

    A document without text is dropped, whatever the size.
    """
    return docs.filter(long_enough(F.col(text), size))


def long_enough(text: Column, size: int) -> Column:
    return text.isNotNull() if size <= 0 else F.length(cleaning.strip(text)) >= size


def wrap_document(
    text: Column, family: str = "tiktoken", folds: Mapping[str, str] | None = None
) -> Column:
    """Start token, cleaned text, end token."""
    token = control.spelling(family)
    return F.concat(
        F.lit(token["start_of_text"]),
        cleaning.clean_text(text, family, folds=folds),
        F.lit(token["end_of_text"]),
    )


def document_at(
    docs: DataFrame, doc_id: int, family: str = "tiktoken", id_col: str = "doc_id"
) -> DataFrame:
    """One wrapped document by its id; the id filter reaches the scan."""
    found = docs.filter(F.col(id_col) == F.lit(doc_id))
    return found.withColumn("text", wrap_document(F.col("text"), family))


def random_document(
    docs: DataFrame, seed: int | str = 0, family: str = "tiktoken", id_col: str = "doc_id"
) -> DataFrame:
    """One wrapped document drawn by seed; only ids are read to draw, then one id is looked up."""
    drawn = docs.select(id_col).orderBy(ordering.hash_key(id_col, seed=seed), id_col).limit(1)
    found = docs.filter(F.col(id_col) == drawn.scalar()).limit(1)
    return found.withColumn("text", wrap_document(F.col("text"), family))


def character_audit(docs: DataFrame, text: str = "text") -> DataFrame:
    """How often each character occurs and whether cleaning lets it pass unchanged."""
    characters = docs.select(F.explode(F.split(text, "")).alias("character")).filter(
        "character != ''"
    )
    return characters.groupBy("character").agg(
        F.count(F.lit(1)).alias("occurrences")
    ).withColumn("authorized", F.col("character").rlike(charsets.PASSING_ONE))
