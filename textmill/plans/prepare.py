"""From raw documents to a stored, tokenized corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill import tables
from textmill.functions import cleaning, wiki
from textmill.operators import documents, encoding, layout, vocabulary
from textmill.session import stored
from textmill.sources import corpus, token_store


def clean_documents(
    docs: DataFrame,
    encyclopedia: bool = True,
    family: str = "tiktoken",
    min_size: int = tables.MIN_DOCUMENT_SIZE,
    keep_control_tokens: bool = False,
) -> DataFrame:
    """Clean ``text``; rows are independent, so ``docs`` may be a stream."""

    def clean(text):
        return cleaning.clean_text(text, family, keep_control_tokens)

    if not encyclopedia:
        return documents.min_size(docs, min_size).withColumn("text", clean(F.col("text")))
    # the size is that of the tightened text; as a filter of its own it would be pushed
    # below the projection and tighten every text a second time
    tightened = F.filter(
        F.array(wiki.clean_wiki(F.col("text"))),
        lambda text: documents.long_enough(text, min_size),
    )
    columns = [c for c in docs.columns if c != "text"]
    return docs.select(*columns, F.explode(F.transform(tightened, clean)).alias("text"))


def prepare_corpus(
    docs: DataFrame,
    path: str,
    name: str,
    vocab: DataFrame | None = None,
    ranks: DataFrame | None = None,
    vocabulary_size: int = tables.VOCABULARY_SIZE,
    training_part: str = "pretraining",
    multiplier: float = tables.DEFAULT_MULTIPLIER,
    ratio: float = tables.VALIDATION_RATIO,
    seed: int | str = 0,
    encyclopedia: bool = True,
    family: str = "tiktoken",
    min_size: int = tables.MIN_DOCUMENT_SIZE,
    keep_control_tokens: bool = False,
    first_control_id: int | None = None,
) -> DataFrame:
    """Clean, split, encode and store a corpus; returns its token shards.

    ``min_size`` and ``keep_control_tokens`` go to the cleaning. ``first_control_id`` is for rank
    tables whose model has special tokens of its own. Encodes with ``ranks`` or with a vocabulary of whole pieces, built from the corpus if
    none is given. The cleaned text is written once; every later step reads that.
    """
    spark = docs.sparkSession
    clean = clean_documents(
        corpus.spread(docs), encyclopedia, family, min_size, keep_control_tokens
    )
    clean.write.mode("overwrite").parquet(f"{path}/clean")
    text = layout.exact_split(spark.read.parquet(f"{path}/clean"), ratio, seed)
    if ranks is not None:
        first = encoding.ranks_size(ranks) if first_control_id is None else first_control_id
        encoded = encoding.encode_with_ranks(
            text, ranks, ["split"], family=family, first_control_id=first
        )
    else:
        if vocab is None:
            counts = stored(vocabulary.piece_counts(text, family=family), "piece_counts")
            vocab = vocabulary.build_vocabulary(counts, vocabulary_size)
            vocab.write.mode("overwrite").parquet(f"{path}/vocabulary")
            vocab = spark.read.parquet(f"{path}/vocabulary")
        encoded = encoding.encode_with_vocabulary(
            text, vocab, vocabulary_size, ["split"], family=family
        )
        first = vocabulary.control_start(vocabulary_size)
    return token_store.save_corpus(
        encoding.add_document_ends(encoded, first), path, name, training_part, multiplier
    )
