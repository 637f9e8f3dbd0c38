"""Long documents in stretches, batches by the number of rows, streams of several corpora."""

import random

import pytest
from pyspark.sql import functions as F

from textmill.functions import pieces
from textmill.operators import encoding, examples, layout, mixing
from textmill.session import stored
from textmill.sources import ranks as rank_files
from textmill.sources import token_store

public_tokenizers = pytest.importorskip("public_tokenizers")

PARTS = ["a", "Bc", " ", "  ", "\n", "'s", "'ll", "1", "é", "!", " the", " word and", "<|tab|>", "<|endoftext|>", "世", " x  y", "\t "]


def texts(seed, n, length):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randrange(length))) for _ in range(n)]


@pytest.mark.parametrize("pattern", ["gpt2", "gpt4"])
def test_no_piece_crosses_a_stretch(spark, pattern):
    rows = list(enumerate([*texts(1, 200, 300), "", None, "one " * 500, "x" * 900, "a b" * 300]))
    docs = spark.createDataFrame(rows, "i int, text string").repartition(4)
    cut = lambda c: pieces.split_pieces_with_control(c, pattern)
    found = docs.select(
        "text",
        pieces.text_stretches(F.col("text"), 40, pattern).alias("parts"),
        cut(F.col("text")).alias("whole"),
    ).withColumn("n", F.size("parts"))
    several = 0
    for r in found.collect():
        assert r.text is None or "".join(r.parts) == r.text
        several += r.n > 2
    apart = docs.select("i", F.posexplode(pieces.text_stretches(F.col("text"), 40, pattern)).alias("k", "part"))
    listed = apart.select("i", "k", cut(F.col("part")).alias("p")).groupBy("i").agg(F.flatten(F.sort_array(F.collect_list(F.struct("k", "p")))["p"]).alias("p"))
    both = docs.select("i", cut(F.col("text")).alias("whole")).join(listed, "i").collect()
    assert several > 50 and len(both) == len(rows)
    assert all((r.whole or []) == (r.p or []) for r in both)
    assert [r.n for r in docs.select(F.size(pieces.text_stretches(F.col("text"), 40, r"\w+|\W+")).alias("n")).distinct().collect()] == [1]


@pytest.fixture(scope="module")
def ranks(spark):
    return rank_files.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_long_documents_in_two_levels(spark, ranks, monkeypatch):
    rows = list(enumerate([*texts(2, 40, 900), "", None]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plain = {r.doc_id: r.tokens for r in encoding.encode_with_ranks(docs, ranks).collect()}
    monkeypatch.setattr(encoding, "STRETCH_CHARACTERS", 60)
    monkeypatch.setattr(encoding, "STRETCH_TOKENS", 7)
    encoded = stored(encoding.encode_with_ranks(docs, ranks), "encoded")
    assert {r.doc_id: r.tokens for r in encoded.collect()} == plain
    decoded = {r.doc_id: r.text for r in encoding.decode(encoded, ranks).collect()}
    assert decoded == {i: t or "" for i, t in rows}
    listed = {r.doc_id: r.words for r in encoding.words(encoded, ranks).collect()}
    assert all([w.id for w in listed[i]] == plain[i] for i in plain)


def test_a_document_of_megabytes(spark, ranks):
    """All its pieces come together in order, in groups of a stretch each."""
    text = " ".join(texts(3, 3_000, 60)).replace("<|", "<") + " the end"
    text = text * (6_000_000 // len(text) + 1)
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    encoded = stored(encoding.encode_with_ranks(docs, ranks), "encoded")
    back = encoding.decode(encoded, ranks).filter("doc_id = 1").select(F.length("text").alias("n"), F.md5("text").alias("m")).first()
    assert tuple(back) == tuple(docs.filter("doc_id = 1").select(F.length("text"), F.md5("text")).first())


def test_batches_do_not_depend_on_buckets(spark):
    rows = spark.range(3_000).selectExpr("if(id % 10 = 0, 'val', 'train') AS split", "id AS block")
    one = examples.shuffled_batches(rows, epochs=2, batch_size=64, seed=3)
    for digits in (0, 1, 4):
        other = examples.shuffled_batches(rows, epochs=2, batch_size=64, seed=3, bucket_digits=digits)
        assert one.exceptAll(other).isEmpty() and other.count() == one.count() == 6_000


def corpus(spark, path, name, sizes, multiplier):
    rows = [("train" if i % 4 else "val", i, n, [i] * n) for i, n in enumerate(sizes)]
    encoded = spark.createDataFrame(rows, "split string, doc_id long, size int, tokens array<int>").repartition(3)
    token_store.save_corpus(encoded, str(path), name, multiplier=multiplier, max_shards=4)
    return {i: n for split, i, n, _ in rows if split == "train"}


def test_stored_corpora_become_one_stream(spark, tmp_path):
    draw = random.Random(6)
    own, factors = {}, {"a": 2.25, "b": 0.4, "c": 1.0, "d": 0.0}
    for name, m in factors.items():
        own[name] = corpus(spark, tmp_path / name, name, [draw.randrange(0, 90) for _ in range(120)], m)
    frame = mixing.mixed_stream(spark, {n: str(tmp_path / n) for n in own}, seed=5)
    rows = sorted(frame.collect(), key=lambda r: (r.start, r.size))
    at = 0
    for r in rows:
        assert r.start == at and r.size == len(r.tokens) == own[r.corpus][r.doc_id] and set(r.tokens) <= {r.doc_id}
        at += r.size
    for name, m in factors.items():
        tokens = sum(r.size for r in rows if r.corpus == name)
        assert 0 <= tokens - m * sum(own[name].values()) < 90
        times = [sum(r.corpus == name and r.doc_id == i for r in rows) for i in own[name]]
        assert set(times) <= {int(m), int(m) + (m % 1 > 0)}
    blocks = examples.token_blocks(stored(frame, "stream"), length=16, within=())
    stream = [t for r in rows for t in r.tokens]
    assert {r.block: r.tokens for r in blocks.collect()} == {b: stream[b * 16 : b * 16 + 17] for b in range(-(-(len(stream) - 1) // 16))}
    again = mixing.mixed_stream(spark, {n: str(tmp_path / n) for n in own}, seed=5)
    assert again.exceptAll(frame).isEmpty()
    assert not mixing.mixed_stream(spark, {n: str(tmp_path / n) for n in own}, seed=6).exceptAll(frame).isEmpty()


def test_entries_of_odd_indexes(spark):
    index = spark.createDataFrame([("a", 1, 0, 5), ("a", 1, 0, 5), ("a", None, 5, None), ("z", 1, 0, 9)], "corpus string, doc_id long, start long, size int")
    factors = spark.createDataFrame([("a", 1.0), ("none", 3.0)], "corpus string, multiplier double")
    rows = mixing.stream_entries(index, factors).collect()
    assert sorted((r.size, r.copy) for r in rows) == [(0, 1), (5, 1), (5, 1)] and sorted(r.start for r in rows if r.size) == [0, 5]
    assert mixing.stream_entries(index.limit(0), factors).count() == 0


def test_offsets_with_many_buckets(spark):
    docs = spark.range(2_000).selectExpr("id AS doc_id", "if(id % 7 = 0, null, 'train') AS split", "cast(id % 5 AS int) AS size")
    few, many = layout.offsets(docs), layout.offsets(docs, rows_per_bucket=16)
    assert few.exceptAll(many).isEmpty() and many.count() == 2_000
