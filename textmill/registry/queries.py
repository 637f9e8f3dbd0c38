"""One query per operator, over the whole test tables.

Cases the tables lack (emoji, control tokens, odd blanks) are put into every document by
plain replacements, so the work still grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.registry.decoration import DECORATIONS
from textmill.functions import cleaning, control, folding, pieces, wiki
from textmill.operators import (
    chat,
    documents,
    encoding,
    examples,
    layout,
    metrics,
    mixing,
    narrow,
    ordering,
    vocabulary,
)
from textmill.plans import prepare
from textmill.session import release, shared_folder, stored
from textmill.sources import corpus, ranks, text_array, token_store

VOCAB = 4_096  # small enough that byte fallback occurs
SEED = 17
MULTIPLIERS = {"src0": 1.0, "src1": 0.5, "src2": 2.25}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _read(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.read_corpus(spark, f"{sf}/documents.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents for row-wise work."""
    return corpus.spread(_read(spark, sf))


def _decorated(docs: DataFrame, kind: str) -> DataFrame:
    return docs.withColumn(
        "text", cleaning.replace_in_order(F.col("text"), DECORATIONS[kind])
    )


def _texts(spark: SparkSession, sf: str, kind: str, result: Callable[[Column], Column]):
    docs = _decorated(_documents(spark, sf), kind)
    return docs.select("doc_id", result(F.col("text")).alias("text"))


def _folder(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- sources and sinks ------------------------------------------------------


@query
def corpus_source(spark, sf):
    docs = corpus.read_corpus(spark, f"{sf}/documents.parquet", source="wikipedia")
    return docs.select("doc_id", "source", F.length("text").alias("characters"))


@query
def corpus_without_ids(spark, sf):
    """The documents as a corpus without a key: a row's position is its id."""
    docs = corpus.read_corpus(spark, f"{sf}/documents.parquet", id_col=None)
    return docs.select("doc_id", "source", F.md5("text").alias("text"))


@query
def corpus_union(spark, sf):
    both = corpus.union_corpora(
        corpus.read_corpus(spark, f"{sf}/documents.parquet", source="wikipedia"),
        corpus.read_corpus(
            spark,
            f"{sf}/pages.parquet",
            source="openwebtext",
            text_col="html",
            id_col="page_id",
        ),
    )
    return both.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.length("text")).alias("characters")
    )


@query
def union_tokens(spark, sf):
    """Two corpora whose ids overlap, encoded together: no document meets another."""
    both = corpus.union_corpora(
        _read(spark, sf),
        corpus.read_corpus(
            spark, f"{sf}/pages.parquet", source="pages", text_col="html", id_col="page_id"
        ),
    )
    encoded = encoding.encode_with_vocabulary(both, _vocabulary(_documents(spark, sf)), VOCAB)
    return encoded.select("doc_id", F.concat_ws(" ", "tokens").alias("tokens"))


@query
def text_array_round_trip(spark, sf):
    path = _folder(spark, "lines")
    text_array.save_text_array(_documents(spark, sf), path, value="text", pos="doc_id")
    return text_array.load_text_array(spark, path)


@query
def control_token_counts(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    text = chat.render_conversations(turns).select(
        cleaning.clean_text(F.col("text"), keep_control_tokens=True).alias("text")
    )
    found = text.select(
        F.explode(F.regexp_extract_all("text", F.lit(control.pattern()), F.lit(0))).alias(
            "tiktoken"
        )
    )
    counts = found.groupBy("tiktoken").agg(F.count(F.lit(1)).alias("occurrences"))
    tokens = control.control_tokens(spark, first_id=VOCAB - 10)
    return tokens.join(counts, "tiktoken", "left").select(
        "name", "custom", "tiktoken", "id", F.coalesce("occurrences", F.lit(0)).alias("n")
    )


@query
def rank_table(spark, sf):
    path = _folder(spark, "ranks")
    ranks.write_ranks(encoding.vocabulary_ranks(_vocabulary(_documents(spark, sf))), path)
    return ranks.read_ranks(spark, path).select(F.hex("token").alias("token"), "id")


def _saved(spark, sf, **options) -> tuple[DataFrame, str]:
    path = _folder(spark, "corpus")
    encoded = _encoded(spark, sf, ratio=0.1)
    return token_store.save_corpus(encoded, path, "wikipedia", multiplier=1.0, **options), path


@query
def token_shards(spark, sf):
    shards, _ = _saved(spark, sf)
    return shards.select(
        "split", "shard", "doc_id", "start", "size", F.concat_ws(" ", "tokens").alias("tokens")
    )


@query
def raw_tokens_read_back(spark, sf):
    """Plain token files, read as bytes: blocks of 64 ids of each split's stream."""
    shards, _ = _saved(spark, sf, max_shards=8)
    path = _folder(spark, "raw")
    dtype = token_store.export_raw(shards, path)
    # blocks inside a row are cut where it is: only its ends meet those of its neighbours
    blocks = examples.token_blocks(token_store.read_raw(spark, path, dtype), length=64)
    return _joined(examples.next_token_examples(blocks, length=64).select("split", "block", "x"), "x")


@query
def offset_index(spark, sf):
    _, path = _saved(spark, sf, max_shards=8)
    return token_store.read_index(spark, path).select("split", "doc_id", "start", "size")


@query
def tokens_by_index(spark, sf):
    """All validation documents, by a table of their ids: only shards that hold one are opened."""
    _, path = _saved(spark, sf)
    ids = token_store.read_index(spark, path).filter("split = 'val'").select("doc_id")
    found = token_store.tokens_at(spark, path, ids)
    return found.select("split", "doc_id", "start", "size", F.concat_ws(" ", "tokens").alias("tokens"))


@query
def raw_tokens_by_index(spark, sf):
    """Every document again, as the byte range of the raw files that the index names."""
    shards, path = _saved(spark, sf, max_shards=8)
    raw = _folder(spark, "raw")
    dtype = token_store.export_raw(shards, raw)
    found = token_store.raw_tokens_at(spark, raw, token_store.read_index(spark, path), dtype)
    return found.select("split", "doc_id", "start", "size", F.concat_ws(" ", "tokens").alias("tokens"))


@query
def corpus_metadata(spark, sf):
    _, path = _saved(spark, sf, max_shards=8)
    return token_store.read_metadata(spark, path).select(
        "training_part",
        "name",
        F.col("size")["train"].alias("train"),
        F.col("size")["val"].alias("val"),
        F.col("size")["test"].alias("test"),
        "multiplier",
    )


# --- cleaning ---------------------------------------------------------------


@query
def drop_carriage_returns(spark, sf):
    return _texts(spark, sf, "returns", cleaning.drop_carriage_returns)


@query
def replace_signs(spark, sf):
    return _texts(spark, sf, "signs", cleaning.replace_signs)


@query
def escape_circled_numbers(spark, sf):
    return _texts(spark, sf, "circled", cleaning.escape_circled_numbers)


@query
def encode_emoji(spark, sf):
    return _texts(spark, sf, "emoji", cleaning.encode_emoji)


@query
def drop_unknown_characters(spark, sf):
    return _texts(spark, sf, "unknown", cleaning.drop_unknown_characters)


@query
def fold_to_ascii(spark, sf):
    return _texts(spark, sf, "folds", cleaning.fold_to_ascii)


@query
def fold_other_scripts(spark, sf):
    return _texts(spark, sf, "scripts", cleaning.fold_to_ascii)


def ideograph_folds() -> dict[str, str]:
    """A table of the size of a full transliteration: every ideograph of two blocks by its code point."""
    return {chr(p): f"u{p:x} " for first, last in ((0x3400, 0x4DBF), (0x4E00, 0x9FFF)) for p in range(first, last + 1)}


@query
def clean_with_large_table(spark, sf):
    """Cleaning with a spelling for each of 27,000 ideographs, which the default table drops."""
    docs = _decorated(_documents(spark, sf), "ideographs")
    folder = folding.table_folder(spark, ideograph_folds())
    return cleaning.clean_with_table(docs, folder).select("doc_id", "text")


@query
def allowed_text(spark, sf):
    return _texts(spark, sf, "everything", cleaning.allowed_text)


@query
def tidy_blanks(spark, sf):
    return _texts(spark, sf, "blanks", cleaning.tidy_blanks)


@query
def strip_text(spark, sf):
    def padded(text):
        return cleaning.strip(F.concat(F.lit(" \t\n　"), text, F.lit(" \n\x1c ")))

    return _texts(spark, sf, "none", padded)


@query
def controls_to_tokens(spark, sf):
    return _texts(
        spark, sf, "blanks", lambda text: cleaning.controls_to_tokens(text, family="custom")
    )


@query
def clean_text(spark, sf):
    return _texts(spark, sf, "none", cleaning.clean_text)


@query
def clean_text_all_cases(spark, sf):
    return _texts(spark, sf, "everything", cleaning.clean_text)


@query
def clean_text_keep_control(spark, sf):
    return _texts(
        spark,
        sf,
        "control",
        lambda text: cleaning.clean_text(text, keep_control_tokens=True),
    )


@query
def decode_emoji(spark, sf):
    return _texts(
        spark, sf, "emoji", lambda text: cleaning.decode_emoji(cleaning.encode_emoji(text))
    )


@query
def unclean_keep_control(spark, sf):
    return _texts(
        spark,
        sf,
        "everything",
        lambda text: cleaning.unclean_text(
            cleaning.clean_text(text), keep_control_tokens=True
        ),
    )


@query
def unclean_conversations(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    return chat.render_conversations(turns).select(
        "conv_id", cleaning.unclean_text(F.col("text")).alias("text")
    )


@query
def wiki_spacing(spark, sf):
    return _texts(spark, sf, "spacing", wiki.tighten_spacing)


@query
def join_digit_commas(spark, sf):
    return _texts(spark, sf, "digits", wiki.join_digit_commas)


@query
def pair_quotes(spark, sf):
    return _texts(spark, sf, "quotes", wiki.pair_quotes)


@query
def clean_wiki(spark, sf):
    return _texts(spark, sf, "wiki", wiki.clean_wiki)


@query
def wiki_then_clean(spark, sf):
    return _texts(
        spark, sf, "wiki", lambda text: cleaning.clean_text(wiki.clean_wiki(text))
    )


@query
def character_audit(spark, sf):
    return documents.character_audit(_decorated(_documents(spark, sf), "everything"))


# --- filters and lookup -----------------------------------------------------


@query
def min_size(spark, sf):
    kept = documents.min_size(_documents(spark, sf), 500)
    return kept.select("doc_id", F.length("text").alias("characters"))


@query
def wrap_document(spark, sf):
    return _texts(spark, sf, "none", documents.wrap_document)


@query
def document_at(spark, sf):
    return documents.document_at(_read(spark, sf), 7).select("doc_id", "text")


@query
def random_document(spark, sf):
    return documents.random_document(_documents(spark, sf), SEED).select("doc_id", "text")


@query
def documents_with_control(spark, sf):
    docs = _decorated(_documents(spark, sf), "some_control")
    return docs.groupBy("source").agg(
        F.count_if(control.holds_control(F.col("text"))).alias("documents")
    )


# --- pieces, vocabulary, tokens ---------------------------------------------


def _pieces(spark, sf, pattern):
    cut = pieces.split_pieces(F.col("text"), pattern)
    return _documents(spark, sf).select("doc_id", F.posexplode(cut).alias("pos", "piece"))


@query
def gpt2_pieces(spark, sf):
    return _pieces(spark, sf, "gpt2")


@query
def gpt4_pieces(spark, sf):
    return _pieces(spark, sf, "gpt4")


@query
def pieces_join_to_text(spark, sf):
    def joined(pattern):
        return F.concat_ws("", pieces.split_pieces(F.col("text"), pattern))

    return _documents(spark, sf).select(
        "doc_id", joined("gpt2").alias("gpt2"), joined("gpt4").alias("gpt4")
    )


def _vocabulary(docs: DataFrame, size: int = VOCAB) -> DataFrame:
    counts = _counts(docs)
    chosen = stored(vocabulary.build_vocabulary(counts, size), "vocabulary")
    release(counts)
    return chosen


def _counts(docs: DataFrame) -> DataFrame:
    return stored(vocabulary.piece_counts(docs), "piece_counts")


@query
def vocabulary_table(spark, sf):
    return vocabulary.build_vocabulary(_counts(_documents(spark, sf)))


@query
def vocabulary_of_clean_text(spark, sf):
    """No part of a control token is a piece."""
    return vocabulary.build_vocabulary(_counts(_clean(spark, sf)), VOCAB)


@query
def prepared_corpus(spark, sf):
    """From raw documents to token shards: clean, filter, split, vocabulary, encode, place, store."""
    shards = prepare.prepare_corpus(
        _read(spark, sf),
        _folder(spark, "prepared"),
        "wikipedia",
        vocabulary_size=VOCAB,
        ratio=0.1,
        seed=SEED,
        min_size=500,
    )
    return shards.select(
        "split", "shard", "doc_id", "start", "size", F.concat_ws(" ", "tokens").alias("tokens")
    )


def _clean(spark, sf) -> DataFrame:
    """Cleaned documents, partitioned by id."""
    docs = corpus.by_document(_read(spark, sf))
    return docs.withColumn("text", cleaning.clean_text(F.col("text")))


def _encoded(spark, sf, ratio) -> DataFrame:
    docs = layout.exact_split(_read(spark, sf), ratio, SEED)
    vocab = _vocabulary(_documents(spark, sf))
    encoded = encoding.encode_with_vocabulary(docs, vocab, VOCAB, ["split"])
    return encoding.add_document_ends(encoded, vocabulary.control_start(VOCAB))


@query
def encode_bytes(spark, sf):
    vocab = _vocabulary(_documents(spark, sf))
    encoded = encoding.encode_with_vocabulary(_read(spark, sf), vocab, VOCAB)
    return encoded.select("doc_id", F.concat_ws(" ", "tokens").alias("tokens"))


@query
def encode_clean_text(spark, sf):
    """Control tokens inside the text become control ids."""
    docs = _clean(spark, sf)
    vocab = _vocabulary(_documents(spark, sf))
    encoded = encoding.encode_with_vocabulary(docs, vocab, VOCAB, partitioned=True)
    return encoded.select("doc_id", F.concat_ws(" ", "tokens").alias("tokens"))


@query
def encode_unknown_token(spark, sf):
    vocab = _vocabulary(_documents(spark, sf))
    encoded = encoding.encode_with_vocabulary(
        _read(spark, sf), vocab, VOCAB, unknown="token"
    )
    return encoded.select("doc_id", F.concat_ws(" ", "tokens").alias("tokens"))


@query
def document_tokens(spark, sf):
    encoded = _encoded(spark, sf, ratio=0.1)
    return encoded.select("doc_id", "split", "size", F.concat_ws(" ", "tokens").alias("tokens"))


@query
def document_sizes(spark, sf):
    docs = _documents(spark, sf)
    return encoding.vocabulary_sizes(docs, _vocabulary(docs), ["source"], size=VOCAB)


def _rank_table(spark, sf) -> DataFrame:
    """Bytes and frequent pieces as ranks; pieces of one byte are bytes already."""
    vocab = _vocabulary(_documents(spark, sf)).filter(F.octet_length("piece") > 1)
    return stored(encoding.vocabulary_ranks(vocab), "ranks")


@query
def encode_ranks(spark, sf):
    """Byte-pair merges for pieces outside the rank table."""
    encoded = encoding.encode_with_ranks(_read(spark, sf), _rank_table(spark, sf))
    return encoded.select("doc_id", F.concat_ws(" ", "tokens").alias("tokens"))


@query
def encode_merged_ranks(spark, sf):
    """Ranks of word beginnings: most pieces are made by merges, and few are ranks themselves."""
    vocab = _vocabulary(_documents(spark, sf)).filter("id < 856")
    prefix = F.expr("explode(transform(sequence(2, greatest(2, length(piece))), n -> left(piece, n)))")
    short = vocab.filter(F.length("piece") >= 2).select(prefix.alias("piece")).distinct()
    rank = F.row_number().over(Window.orderBy(F.octet_length("piece"), "piece"))  # of 600 pieces
    numbered = short.select("piece", (rank + 255).cast("int").alias("id"))
    table = stored(encoding.vocabulary_ranks(numbered), "ranks")
    encoded = encoding.encode_with_ranks(_read(spark, sf), table)
    return encoded.select("doc_id", F.concat_ws(" ", "tokens").alias("tokens"))


@query
def encode_decode_ranks(spark, sf):
    docs = _clean(spark, sf)
    table = _rank_table(spark, sf)
    counts = vocabulary.piece_counts(docs)
    dictionary = stored(encoding.piece_dictionary(counts, table), "dictionary")
    encoded = encoding.encode_with_ranks(
        docs, table, dictionary=dictionary, partitioned=True
    )
    return encoding.decode(encoded, table, partitioned=True)


@query
def decode_bytes(spark, sf):
    vocab = _vocabulary(_documents(spark, sf))
    encoded = encoding.encode_with_vocabulary(_read(spark, sf), vocab, VOCAB)
    return encoding.decode(
        encoded,
        encoding.vocabulary_ranks(vocab),
        first_control_id=vocabulary.control_start(VOCAB),
        partitioned=True,
    )


@query
def token_words(spark, sf):
    vocab = _vocabulary(_documents(spark, sf))
    encoded = encoding.encode_with_vocabulary(_read(spark, sf), vocab, VOCAB)
    named = encoding.words(
        encoded,
        encoding.vocabulary_ranks(vocab),
        first_control_id=vocabulary.control_start(VOCAB),
        distinct=True,
    )
    return named.select("doc_id", F.posexplode("words").alias("pos", "w")).select(
        "doc_id", "pos", F.col("w.id").alias("id"), F.col("w.word").alias("word")
    )


@query
def id_width(spark, sf):
    return vocabulary.id_width(_encoded(spark, sf, ratio=0.1))


# --- split, layout, statistics ----------------------------------------------


def _sized(spark, sf) -> DataFrame:
    return _documents(spark, sf).withColumn("size", F.length("text"))


@query
def exact_split(spark, sf):
    return layout.exact_split(_documents(spark, sf), seed=SEED).select("doc_id", "split")


@query
def hash_split(spark, sf):
    return layout.hash_split(_documents(spark, sf), 0.2, SEED).select("doc_id", "split")


@query
def offsets_and_shards(spark, sf):
    docs = layout.exact_split(_sized(spark, sf), 0.1, SEED).select("doc_id", "split", "size")
    return layout.offsets(docs, rows_per_bucket=64)


@query
def split_sizes(spark, sf):
    return layout.split_sizes(layout.exact_split(_sized(spark, sf), 0.1, SEED))


@query
def mix_report(spark, sf):
    return layout.mix_report(_sized(spark, sf))


@query
def repeat_documents(spark, sf):
    repeated = layout.repeat_documents(
        _documents(spark, sf), {"src0": 1.0, "src1": 0.5, "src2": 2.25}, seed=SEED
    )
    return repeated.select("doc_id", "source", "copy")


def _source_index(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The documents of each source as a corpus of its own, its index and multipliers."""
    sized = _sized(spark, sf).select(F.col("source").alias("split"), "doc_id", "size")
    placed = layout.offsets(sized).select(F.col("split").alias("corpus"), "doc_id", "start", "size")
    names = placed.select("corpus").distinct()
    factor = layout.multiplier_of(F.col("corpus"), MULTIPLIERS, default=1.0)
    return placed, names.select("corpus", factor.alias("multiplier"))


@query
def mixed_stream_entries(spark, sf):
    """A training stream of all sources by their multipliers, from index entries alone."""
    return mixing.stream_entries(*_source_index(spark, sf), seed=SEED)


@query
def mixed_stream_shares(spark, sf):
    """Tokens of each source in the stream: its own times the multiplier, to within a document."""
    return mixing.shares(mixing.stream_entries(*_source_index(spark, sf), seed=SEED))


@query
def mixed_stream_tokens(spark, sf):
    """Two stored corpora as one stream of tokens, with copies by their stored multipliers."""
    paths = {}
    encoded = stored(_encoded(spark, sf, ratio=0.1), "encoded")  # both corpora have the same documents
    for name, multiplier in (("twice", 2.0), ("half", 0.5)):
        paths[name] = _folder(spark, name)
        token_store.save_corpus(encoded, paths[name], name, multiplier=multiplier, max_shards=8, held=True)
    release(encoded)
    found = mixing.mixed_stream(spark, paths, seed=SEED)
    return found.select("corpus", "doc_id", "copy", "size", "start", F.concat_ws(" ", "tokens").alias("tokens"))


# --- examples and chat ------------------------------------------------------


def _placed(spark, sf) -> DataFrame:
    held = stored(_encoded(spark, sf, ratio=0.1), "encoded")
    short, widened = narrow.narrowed(held, "tokens")
    placed = stored(widened(layout.offsets(short, rows_per_bucket=64)), "placed")
    release(held)
    return placed


def _examples(spark, sf) -> DataFrame:
    return examples.next_token_examples(examples.token_blocks(_placed(spark, sf)))


def _joined(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({n: F.concat_ws(" ", F.col(n).cast("array<string>")) for n in names})


@query
def next_token_examples(spark, sf):
    return _joined(_examples(spark, sf), "x", "y")


@query
def padded_examples(spark, sf):
    padding = control.control_id("padding", vocabulary.control_start(VOCAB))
    padded = examples.pad_examples(_examples(spark, sf), padding)
    return padded.select(
        "split",
        "block",
        F.concat_ws(" ", "x").alias("x"),
        F.concat_ws(" ", "y").alias("y"),
        F.size(F.filter("mask", lambda m: m)).alias("counted"),
    )


@query
def shuffled_batches(spark, sf):
    placed = _placed(spark, sf)
    blocks = stored(examples.token_blocks(placed), "blocks")  # x and y are cut from them where they are read
    release(placed)
    batches = examples.shuffled_batches(examples.next_token_examples(blocks), epochs=2, seed=SEED)
    return _joined(batches.select("split", "epoch", "batch", "slot", "block", "x"), "x")


@query
def render_conversations(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    return chat.render_conversations(turns)


@query
def render_conversations_in_parts(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    return chat.render_conversations(turns, family="custom", turns_per_part=3)


# --- run metrics ------------------------------------------------------------


def _records(spark, sf) -> DataFrame:
    """Events as saves of runs: a user is a run, its events in time are the iterations."""
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("user_id").cast("string").alias("run"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        "value",
    )
    hours = events.withColumn("_hour", F.floor(F.unix_seconds(F.col("ts")) / 3600))
    numbered = ordering.row_index(
        hours, ["ts", "event_id"], "_hour", within=["run"], name="iter"
    )
    return numbered.select(
        "run",
        "ts",
        "iter",
        ((F.col("iter") + 1) * 8_192).alias("tokens"),
        F.floor(F.col("iter") / 20).alias("epochs"),
        F.col("value").alias("loss"),
        (F.col("value") * 2).alias("val_loss"),
    )


@query
def metric_records(spark, sf):
    path = _folder(spark, "metrics")
    scored = _records(spark, sf).withColumns(
        {
            "time": F.unix_micros("ts") / F.lit(1e6),
            "accuracy": 1 / (1 + F.abs("loss")),
            "val_accuracy": 1 / (1 + F.abs("val_loss")),
        }
    )
    records = metrics.as_records(metrics.with_running_best(scored))
    metrics.append_metrics(records.filter("epochs = 0"), path)
    metrics.append_metrics(records.filter("NOT (epochs <=> 0)"), path)
    return metrics.read_metrics(spark, path).drop("ts")


@query
def metric_records_with_gaps(spark, sf):
    """Records whose run or iteration is missing stay rows like any other."""
    lost = _records(spark, sf).withColumns(
        {
            "run": F.when(F.col("iter") % 7 != 3, F.col("run")),
            "iter": F.when(F.col("iter") % 11 != 5, F.col("iter")),
        }
    )
    timed = metrics.with_elapsed(metrics.with_running_best(lost, per_bucket=16), per_bucket=16)
    return timed.groupBy("run").agg(
        F.count(F.lit(1)).alias("saves"), F.count("iter").alias("numbered")
    )


@query
def metric_elapsed(spark, sf):
    timed = metrics.with_elapsed(_records(spark, sf), per_bucket=16)
    return timed.select("run", "iter", "elapsed")


@query
def metric_running_best(spark, sf):
    best = metrics.with_running_best(_records(spark, sf), per_bucket=16)
    return best.select("run", "iter", "best_val_loss")


@query
def metric_resume(spark, sf):
    return metrics.latest_metrics(_records(spark, sf))


@query
def metric_epoch_losses(spark, sf):
    losses = metrics.epoch_losses(_records(spark, sf))
    return losses.select("run", "epochs", F.round("epoch_loss", 6).alias("epoch_loss"), "batches")


@query
def metric_validation_rows(spark, sf):
    return metrics.validation_rows(_records(spark, sf)).select("run", "iter", "val_loss")


# --- several operators in a row ---------------------------------------------


@query
def pieces_per_source(spark, sf):
    """Clean, filter by size, cut into pieces, report the mix."""
    docs = documents.min_size(_documents(spark, sf), 100).withColumn(
        "text", cleaning.clean_text(F.col("text"))
    )
    sized = docs.select(
        "source", F.size(pieces.split_pieces_with_control(F.col("text"))).alias("size")
    )
    return layout.mix_report(sized)
