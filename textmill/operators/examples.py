"""Next-token training examples and shuffled batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill import tables
from textmill.operators import narrow, ordering
from textmill.session import shuffles_dropped, stored

ROWS_PER_BUCKET = 1 << 14
MOST_DIGITS = 7


def _piece_of(tokens: str, start: str, block: Column, length: int) -> Column:
    """Tokens of a document that fall into block positions ``[block*L, block*L + L]``."""
    first = F.greatest(block * length - F.col(start), F.lit(0).cast("long"))
    last = F.least(
        block * length + length - F.col(start), F.size(tokens).cast("long") - 1
    )
    return F.slice(tokens, (first + 1).cast("int"), (last - first + 1).cast("int"))


def token_blocks(
    stored: DataFrame,
    length: int = tables.CONTEXT_SIZE,
    tokens: str = "tokens",
    start: str = "start",
    within: Sequence[str] = ("split",),
) -> DataFrame:
    """Cut the token stream of each group into blocks: ``(*within, block, tokens)``.

    Block ``b`` holds stream positions ``b*L`` to ``b*L + L``, so neighbours share one
    token. Blocks inside one document are made where the document is; only the at most
    two unfinished blocks at its ends are shuffled and joined with those of its
    neighbours. ``stored`` should be a stored table, it is read twice.
    """
    size = F.size(tokens).cast("long")
    end = F.col(start) + size
    lowest = F.floor(F.greatest(F.col(start) - 1, F.lit(0)) / length)
    highest = F.floor((end - 1) / length)
    first_full = F.ceil(F.col(start) / length)
    last_full = F.floor((end - length - 1) / length)
    placed = stored.filter(size > 0).select(
        *within,
        F.col(tokens).alias("tokens"),
        F.col(start).cast("long").alias("start"),
        lowest.cast("long").alias("_lowest"),
        highest.cast("long").alias("_highest"),
        first_full.cast("long").alias("_first"),
        last_full.cast("long").alias("_last"),
    )
    cut = _piece_of("tokens", "start", F.col("block"), length)

    def full(block: Column) -> Column:
        # cut before the rows are made: none of them carries the whole document
        return F.struct(block.alias("block"), _piece_of("tokens", "start", block, length).alias("tokens"))

    inside = (
        placed.filter("_first <= _last")
        .select(*within, F.explode(F.transform(F.sequence("_first", "_last"), full)).alias("_part"))
        .select(*within, "_part.block", "_part.tokens")
    )
    ends = F.filter(
        F.array_distinct(F.array("_lowest", "_highest")),
        lambda block: (block < F.col("_first")) | (block > F.col("_last")),
    )
    # a group is one block: never more than L + 1 tokens
    joined = (
        placed.withColumn("block", F.explode(ends))
        .select(*within, "block", F.struct("start", cut.alias("tokens")).alias("part"))
        .groupBy(*within, "block")
        .agg(F.sort_array(F.collect_list("part")).alias("parts"))
        .select(*within, "block", F.flatten(F.col("parts")["tokens"]).alias("tokens"))
    )
    return inside.unionByName(joined)


def next_token_examples(blocks: DataFrame, length: int = tables.CONTEXT_SIZE) -> DataFrame:
    """Blocks to ``x`` (the first L tokens) and ``y`` (the token after each of them)."""
    keys = [c for c in blocks.columns if c != "tokens"]
    return blocks.select(
        *keys,
        F.slice("tokens", 1, length).alias("x"),
        F.slice("tokens", 2, length).alias("y"),
    )


def pad_examples(
    examples: DataFrame, padding_id: int, length: int = tables.CONTEXT_SIZE
) -> DataFrame:
    """Fill ``x`` and ``y`` up with padding; ``mask`` is true where ``y`` counts."""

    def padded(name: str) -> Column:
        room = F.lit(length) - F.size(name)
        return F.concat(name, F.array_repeat(F.lit(padding_id), room))

    return examples.withColumns({"x": padded("x"), "y": padded("y")}).withColumn(
        "mask", F.transform("y", lambda target: target != padding_id)
    )


def shuffled_batches(
    examples: DataFrame,
    epochs: int = tables.EPOCHS,
    batch_size: int = tables.BATCH_SIZE,
    seed: int | str = 0,
    key: Sequence[str] = ("split", "block"),
    within: Sequence[str] = ("split",),
    bucket_digits: int | None = None,
) -> DataFrame:
    """Every example once per epoch, in a fresh random order: ``epoch, batch, slot``.

    Batches are numbered inside each group of ``within``: training and validation never mix.
    Columns of ``key`` and ``within`` that the table lacks are left out.
    The order is that of a hash of example, epoch and seed. Hash prefixes are the buckets
    of the numbering, of even size whatever the examples are; there are as many as the examples need at about
    ``ROWS_PER_BUCKET`` each, unless ``bucket_digits`` says how many hexadecimal digits a prefix has. Batches
    do not depend on it. Only keys are numbered, and stored; the examples are shuffled once, whatever the number of epochs, with
    ids in two bytes where they fit. Examples without a key of their own are numbered as whole rows. ``examples`` should be a stored
    table, it is read four times.
    """
    key = [c for c in key if c in examples.columns]
    within = [c for c in within if c in examples.columns]
    named = list(dict.fromkeys([*key, *within]))
    spark = examples.sparkSession
    with shuffles_dropped(spark):
        each = examples.groupBy(*named).agg(F.count(F.lit(1)).alias("n"))
        found = each.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    rows, alone = found["rows"] or 0, (found["most"] or 0) <= 1
    if bucket_digits is None:
        bucket_digits = 0
        while bucket_digits < MOST_DIGITS and rows > ROWS_PER_BUCKET * 16**bucket_digits:
            bucket_digits += 1
    short, widened = narrow.narrowed(examples, *[c for c in examples.columns if c not in named])
    order_key = ordering.hash_key(*key, "epoch", seed=seed)
    keyed = (
        (short.select(*named) if alone else short)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("_order", order_key)
        .withColumn("_bucket", ordering.hash_bucket(F.col("_order"), bucket_digits) if bucket_digits else F.lit(0))
    )
    numbered = ordering.row_index(
        keyed, ["_order", *key], "_bucket", within=[*within, "epoch"], name="_row"
    )
    if alone:
        places = stored(numbered.select(*named, "epoch", "_row"), "places")
        numbered = ordering.null_safe_join(places, short, named)
    return widened(numbered).select(
        *examples.columns,
        "epoch",
        F.floor(F.col("_row") / batch_size).alias("batch"),
        (F.col("_row") % batch_size).cast("int").alias("slot"),
    )
