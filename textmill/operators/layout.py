"""Split, offsets, shards, sizes, corpus mix and repetition."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textmill import tables
from textmill.operators import ordering


def exact_split(
    docs: DataFrame,
    ratio: float = tables.VALIDATION_RATIO,
    seed: int | str = 0,
    id_col: str = "doc_id",
) -> DataFrame:
    """Add ``split``: exactly ``ceil(n * ratio)`` documents are ``val``, the rest ``train``.

    The validation documents are those with the smallest hash keys. Only the key at
    the cut is looked for: counts per key prefix (at most 65,536 rows) tell which
    prefix holds it, and only that prefix, one 65,536th of the ids, is ranked. The
    texts are never sorted or shuffled.
    """
    key = ordering.hash_key(id_col, seed=seed)
    keyed = docs.select(F.col(id_col).alias("_id"), key.alias("_key")).withColumn(
        "_prefix", ordering.hash_bucket(F.col("_key"), digits=4)
    )
    counts = keyed.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("n")).select(
        F.ceil(F.coalesce("n", F.lit(0)) * F.lit(float(ratio))).alias("k")
    )
    upto = Window.orderBy("_prefix")  # at most 65,536 rows
    cut = (
        counts.withColumn("_upto", F.sum("_n").over(upto))
        .withColumn("_need", total.scalar() - (F.col("_upto") - F.col("_n")))
        .filter((F.col("_need") > 0) & (F.col("_need") <= F.col("_n")))
        .select(F.struct("_prefix", "_need").alias("cut"))
        .scalar()
    )
    at_cut = keyed.filter(F.col("_prefix") == cut["_prefix"]).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_prefix").orderBy("_key", "_id"))
    )
    last = at_cut.filter(F.col("_rank") == cut["_need"]).select(
        F.struct("_key", "_id").alias("last")
    )
    return docs.withColumn(
        "split",
        F.when(F.struct(key, F.col(id_col)) <= last.scalar(), "val").otherwise("train"),
    )


def hash_split(
    docs: DataFrame,
    ratio: float = tables.VALIDATION_RATIO,
    seed: int | str = 0,
    id_col: str = "doc_id",
) -> DataFrame:
    """Add ``split`` row by row: about ``ratio`` of the documents are ``val``.

    Needs no pass over the data and so also works on a stream.
    """
    share = ordering.hash_fraction(ordering.hash_key(id_col, seed=seed))
    return docs.withColumn("split", F.when(share < ratio, "val").otherwise("train"))


def shard_count(documents: Column, limit: int = tables.MAX_SHARDS) -> Column:
    """``limit`` halved until it is below the number of documents, at least one."""
    count = F.lit(1)
    for halvings in range(limit.bit_length() - 1, -1, -1):
        count = F.when(documents > limit >> halvings, limit >> halvings).otherwise(count)
    return count.cast("int")


def shard_of(index: Column, documents: Column, shards: Column) -> Column:
    """Shard of a row: sizes differ by at most one, larger shards come first."""
    small = F.floor(documents / shards).cast("long")
    larger = documents % shards
    in_larger = larger * (small + 1)
    return (
        F.when(index < in_larger, F.floor(index / (small + 1)))
        .otherwise(larger + F.floor((index - in_larger) / small))
        .cast("int")
    )


def offsets(
    docs: DataFrame,
    size: str = "size",
    id_col: str = "doc_id",
    max_shards: int = tables.MAX_SHARDS,
    rows_per_bucket: int = ordering.ROWS_PER_BUCKET,
    tokens_per_bucket: int | None = None,
) -> DataFrame:
    """Add ``start``, ``row_index`` and ``shard`` per ``split``, in ``id_col`` order.

    ``start`` is the number of tokens of the split before this document. Give it a
    narrow or stored table: the ids and sizes are read once for the bucket
    boundaries, once for the bucket totals and once for the result. Rows that carry their tokens
    need ``tokens_per_bucket``: a bucket then has about so many tokens, and no more rows than without.
    """
    if tokens_per_bucket is None:
        bucketed = ordering.with_range_bucket(docs, id_col, "_bucket", rows_per_bucket)
    else:
        each = -(-tokens_per_bucket // rows_per_bucket)
        weight = F.coalesce(F.col(size).cast("long"), F.lit(0)) + each
        bucketed = ordering.with_range_bucket(docs, id_col, "_bucket", tokens_per_bucket, weight)
    placed = ordering.running_totals(
        bucketed,
        {"start": F.col(size).cast("long"), "row_index": F.lit(1).cast("long")},
        order=[id_col],
        bucket="_bucket",
        within=["split"],
    ).drop("_bucket")
    # one row per split
    documents = docs.groupBy("split").agg(F.count(F.lit(1)).alias("_documents"))
    return (
        ordering.null_safe_join(placed, F.broadcast(documents), ["split"])
        .withColumn("_shards", shard_count(F.col("_documents"), max_shards))
        .withColumn(
            "shard", shard_of(F.col("row_index"), F.col("_documents"), F.col("_shards"))
        )
        .select(*docs.columns, "start", "row_index", "shard")
    )


def split_sizes(
    docs: DataFrame, tokens: str = "size", text: str | None = "text"
) -> DataFrame:
    """Documents, tokens and characters per split."""
    sums = [
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum(F.col(tokens).cast("long")), F.lit(0)).alias("tokens"),
    ]
    if text is not None:
        length = F.length(text).cast("long")
        sums.append(F.coalesce(F.sum(length), F.lit(0)).alias("characters"))
    return docs.groupBy("split").agg(*sums)


def metadata(
    sizes: DataFrame,
    name: str,
    training_part: str,
    multiplier: float = tables.DEFAULT_MULTIPLIER,
    measure: str = "tokens",
) -> DataFrame:
    """One row that describes a stored corpus.

    The splits ``train``, ``val`` and ``test`` are always in, with size 0 where they have no rows;
    any other split follows with its own size. A null split is named by an empty text.
    """
    usual = ("train", "val", "test")
    entry = F.struct(F.coalesce("split", F.lit("")), F.col(measure).cast("long"))
    found = F.map_from_entries(F.sort_array(F.collect_list(entry)))
    zero = F.lit(0).cast("long")
    first = F.map_from_entries(
        F.array(*[F.struct(F.lit(s), F.coalesce(F.col("_found")[s], zero)) for s in usual])
    )
    size = F.map_concat(first, F.map_filter("_found", lambda split, _: ~split.isin(*usual)))
    return sizes.agg(found.alias("_found")).select(
        F.lit(training_part).alias("training_part"),
        F.lit(name).alias("name"),
        size.alias("size"),
        F.lit(float(multiplier)).alias("multiplier"),
    )


def mix_report(docs: DataFrame, tokens: str = "size", source: str = "source") -> DataFrame:
    """Documents, tokens and share of tokens per source, and a ``Total`` row."""
    per_source = docs.groupBy(source).agg(
        F.count(F.lit(1)).alias("_documents"),
        F.coalesce(F.sum(F.col(tokens).cast("long")), F.lit(0)).alias("_tokens"),
    )
    # the total is one value, so sources never meet in one task
    summed = per_source.rollup(source).agg(
        F.sum("_documents").alias("documents"),
        F.sum("_tokens").alias("tokens"),
        F.grouping(source).alias("_total"),
    )
    everything = docs.agg(F.sum(F.col(tokens).cast("long"))).scalar()
    return summed.withColumn("_all", everything).select(
        F.when(F.col("_total") == 1, "Total").otherwise(F.col(source)).alias("source"),
        "documents",
        "tokens",
        F.when(F.col("_all") > 0, F.round(100.0 * F.col("tokens") / F.col("_all"), 4)).alias(
            "ratio"
        ),
    )


def multiplier_of(
    source: Column,
    multipliers: Mapping[str, float] | None = None,
    default: float = tables.DEFAULT_MULTIPLIER,
) -> Column:
    """Repetition factor of a source."""
    multipliers = tables.SOURCE_MULTIPLIERS if multipliers is None else multipliers
    factor = F.lit(float(default))
    for name, value in multipliers.items():
        factor = F.when(source == name, F.lit(float(value))).otherwise(factor)
    return factor


def repeat_documents(
    docs: DataFrame,
    multipliers: Mapping[str, float] | None = None,
    default: float = tables.DEFAULT_MULTIPLIER,
    seed: int | str = 0,
    id_col: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """Repeat each document by its source's factor; adds ``copy``, from 1.

    A factor of 2.25 gives every document two copies and a quarter of them, chosen
    by hash, a third. Factors below one thin a source out.
    """
    factor = multiplier_of(F.col(source), multipliers, default)
    share = ordering.hash_fraction(ordering.hash_key(id_col, seed=seed))
    whole = F.floor(factor)
    copies = (whole + F.when(share < factor - whole, 1).otherwise(0)).cast("int")
    return (
        docs.withColumn("_copies", copies)
        .filter("_copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "_copies")))
        .drop("_copies")
    )
