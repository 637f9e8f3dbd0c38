"""One training stream over several stored corpora, made from their offset indexes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.operators import narrow, ordering
from textmill.session import stored
from textmill.sources import token_store

ROWS_PER_BUCKET = 1 << 16


def _digits(rows: int) -> int:
    """Hexadecimal digits of a hash prefix that cuts so many rows into buckets of ``ROWS_PER_BUCKET``."""
    digits = 1
    while digits < 7 and rows > ROWS_PER_BUCKET * 16**digits:
        digits += 1
    return digits


def stream_entries(index: DataFrame, multipliers: DataFrame, seed: int | str = 0) -> DataFrame:
    """``(corpus, doc_id, copy, source_start, size, start)``: which document stands where in the mixed stream.

    ``index`` has ``(corpus, doc_id, start, size)`` of all corpora, ``multipliers`` one row ``(corpus, multiplier)`` each.
    A corpus takes part ``floor(multiplier)`` times whole, and with the documents that begin in the first
    ``multiplier - floor(multiplier)`` of its tokens in hash order once more: its tokens in the stream are ``multiplier`` times its
    own to within one document. Copies of all corpora are interleaved by the hash of corpus, document, copy and seed. Only index
    entries are shuffled. A corpus without a multiplier is left out, as are those of 0 or less; null sizes count as 0.
    """
    parts = F.broadcast(multipliers.select("corpus", F.col("multiplier").cast("double").alias("_m")))  # one row per corpus
    known = index.select("corpus", "doc_id", F.col("start").alias("source_start"), F.coalesce("size", F.lit(0)).alias("size")).join(parts, "corpus")
    keyed = known.withColumn("_key", ordering.hash_key("corpus", "doc_id", seed=seed))
    held = stored(keyed, "entries")
    rows = held.count()
    digits = _digits(rows)
    placed = ordering.running_totals(
        held.withColumn("_bucket", ordering.hash_bucket(F.col("_key"), digits)),
        {"_before": F.col("size").cast("long")},
        order=["_key", "doc_id", "source_start"],
        bucket="_bucket",
        within=["corpus"],
    )
    totals = F.broadcast(held.groupBy("corpus").agg(F.sum("size").alias("_tokens")))
    whole = F.floor("_m")
    again = F.col("_before") < (F.col("_m") - whole) * F.col("_tokens")
    copies = (F.greatest(whole, F.lit(0)) + F.when(again & (F.col("_m") > 0), 1).otherwise(0)).cast("int")
    repeated = (
        placed.join(totals, "corpus")
        .withColumn("_copies", copies)
        .filter("_copies > 0")
        .select("corpus", "doc_id", "source_start", "size", F.explode(F.sequence(F.lit(1), "_copies")).alias("copy"))
        .withColumn("_order", ordering.hash_key("corpus", "doc_id", "copy", seed=seed))
    )
    held = stored(repeated, "copies")
    digits = _digits(held.count())
    streamed = ordering.running_totals(
        held.withColumn("_bucket", ordering.hash_bucket(F.col("_order"), digits)),
        {"start": F.col("size").cast("long")},
        order=["_order", "corpus", "doc_id", "copy", "source_start"],
        bucket="_bucket",
    )
    return streamed.select("corpus", "doc_id", "copy", "source_start", "size", "start")


def mixed_stream(spark: SparkSession, paths: Mapping[str, str], split: str = "train", seed: int | str = 0) -> DataFrame:
    """``(corpus, doc_id, copy, size, start, tokens)`` of stored corpora, by name and path, each by its stored multiplier.

    Tokens are read once from the shards, joined by their place, and have their place in the mixed stream: the result is what
    :func:`examples.token_blocks` cuts blocks from. Documents of a corpus that takes part with a fraction stand first in its hash
    order: those beyond the last one taken are not shuffled.
    """
    own = lambda frame, name: frame.filter(F.col("split") == split).withColumn("corpus", F.lit(name))
    indexes, factors = [], []
    for name, path in paths.items():
        indexes.append(own(token_store.read_index(spark, path), name).select("corpus", "doc_id", "start", "size"))
        factors.append(token_store.read_metadata(spark, path).select(F.lit(name).alias("corpus"), "multiplier"))
    union = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(union(frames[1:]))
    entries = stored(stream_entries(union(indexes), union(factors), seed), "stream")
    key = ordering.hash_key("corpus", "doc_id", seed=seed)
    last = {r.corpus: r.key for r in entries.groupBy("corpus").agg(F.max(key).alias("key")).collect()}  # one row per corpus
    shards = [
        own(token_store.read_shards(spark, path), name).select("corpus", "doc_id", "start", "tokens").filter(key <= F.lit(last.get(name, "")))
        for name, path in paths.items()
    ]
    tokens, widened = narrow.narrowed(union(shards).withColumnRenamed("start", "source_start"), "tokens")
    found = entries.join(tokens, ["corpus", "doc_id", "source_start"])
    return widened(found.select("corpus", "doc_id", "copy", "size", "start", "tokens"))


def shares(entries: DataFrame) -> DataFrame:
    """Documents, tokens and share of the stream per corpus."""
    sums = entries.groupBy("corpus").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("size").cast("long")).alias("tokens"))
    # one row per corpus
    return sums.withColumn("share", F.round(F.col("tokens") / F.sum("tokens").over(Window.partitionBy()), 6))
