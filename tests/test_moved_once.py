"""Tokens are not moved to be put together, and travel narrow where they must; what is done with goes from disk."""

import hashlib
import os

from pyspark.sql import functions as F

from textmill import session
from textmill.operators import encoding, examples, mixing, narrow
from textmill.sources import token_store


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_words_move_only_the_text(spark, tmp_path, monkeypatch):
    """Stretches come together where they were looked up, also those of long texts and in small parts."""
    monkeypatch.setattr(encoding, "JOINED_BYTES", 0)
    monkeypatch.setattr(encoding, "STRETCH_CHARACTERS", 30)
    monkeypatch.setattr(encoding, "STRETCH_TOKENS", 4)
    rows = [(i, None if i == 7 else " ab cd" * (i * 3) + "é") for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    vocab = spark.createDataFrame([(" ab", 256), ("cd", 257)], "piece string, id int")
    for most in (1 << 20, 5):
        monkeypatch.setattr(encoding, "LOOKED_UP_AT_ONCE", most)
        encoded = encoding.encode_with_vocabulary(docs, vocab, 300)
        named = encoding.words(encoded, encoding.vocabulary_ranks(vocab), first_control_id=290, distinct=True)
        assert _plan(named).count("Exchange") == 1
        found = {r.doc_id: [(w.id, w.word) for w in r.words] for r in named.collect()}
        each = [(256, " ab"), (32, " "), (99, "c"), (100, "d")]
        assert found == {i: [] if i == 7 else each * (i * 3) + [(0xC3, "�"), (0xA9, "�")] for i, _ in rows}
        text = encoding.decode(encoded, encoding.vocabulary_ranks(vocab), first_control_id=290, distinct=True)
        assert _plan(text).count("Exchange") == 1 and {r.doc_id: r.text for r in text.collect()} == {i: t or "" for i, t in rows}


def test_shuffle_files_go_with_the_write(spark):
    before = spark.conf.get(session.SHUFFLE_CLEANUP, None)
    with session.scope(spark):
        held = session.stored(spark.range(1_000).repartition(4, "id"), "moved")
        assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == before
        path = held._stored_at
        assert held.agg(F.sum("id")).first()[0] == 499_500 and os.path.exists(path.removeprefix("file:"))
        session.release(held)
        assert not os.path.exists(path.removeprefix("file:"))


def test_ids_travel_narrow_and_come_back(spark):
    for ids in ([0, None, 40_000], [-7, 32_767], [-1, 65_535], [1 << 20], [], [65_535, 0]):
        frame = spark.createDataFrame([(1, ids), (2, None), (3, [])], "i int, tokens array<int>")
        short, widened = narrow.narrowed(frame, "tokens")
        fits = ids not in ([-1, 65_535], [1 << 20])
        assert short.schema["tokens"].dataType.simpleString() == ("array<smallint>" if fits else "array<int>")
        assert widened(short).schema == frame.schema and sorted(widened(short).collect()) == sorted(frame.collect())


def test_one_stored_encoding_for_several_corpora(spark, tmp_path):
    """A held table is not written again; tokens and what a fraction leaves out are not shuffled in full."""
    rows = [("train" if i % 5 else "val", i, 3, [i, 300, 4]) for i in range(200)]
    encoded = spark.createDataFrame(rows, "split string, doc_id long, size int, tokens array<int>")
    with session.scope(spark):
        held = session.stored(encoded, "encoded")
        for name, m in (("whole", 1.0), ("tenth", 0.1), ("none", 0.0)):
            shards = token_store.save_corpus(held, str(tmp_path / name), name, multiplier=m, max_shards=4, held=True)
            assert sorted(r.doc_id for r in shards.collect()) == list(range(200))
            assert not os.path.exists(tmp_path / name / "encoded")
        assert held.count() == 200
        frame = mixing.mixed_stream(spark, {n: str(tmp_path / n) for n in ("whole", "tenth", "none")}, seed=2)
        assert "array<smallint>" in _plan(frame)
        moved = frame._jdf.queryExecution().optimizedPlan().toString()
        assert moved.count("md5(") >= 3
        found = frame.collect()
    assert all(r.tokens == [r.doc_id, 300, 4] for r in found)
    assert sorted(r.doc_id for r in found if r.corpus == "whole") == [i for i in range(200) if i % 5]
    assert len([r for r in found if r.corpus == "tenth"]) == 16 and not [r for r in found if r.corpus == "none"]


def test_examples_are_shuffled_once_for_all_epochs(spark):
    rows = [(None if b % 9 == 4 else "train", b, [b, 40_000], [b % 7]) for b in range(300)]
    frame = spark.createDataFrame(rows, "split string, block long, x array<int>, y array<int>")
    with session.scope(spark):
        batches = examples.shuffled_batches(frame, epochs=3, batch_size=16, seed=1)
        assert "array<smallint>" in _plan(batches) and "explode" not in _plan(batches)
        assert batches.schema["x"].dataType.simpleString() == "array<int>"
        found = batches.collect()
        twice = examples.shuffled_batches(frame.unionByName(frame.filter("block < 5")), epochs=3, batch_size=16, seed=1)
        assert twice.count() == 3 * 305
    assert len(found) == 900 and all([r.split, r.block, r.x, r.y] == list(rows[r.block]) for r in found)
    for split in ("train", None):
        for epoch in range(3):
            own = sorted((r for r in found if r.split == split and r.epoch == epoch), key=lambda r: (r.batch, r.slot))
            assert [(r.batch, r.slot) for r in own] == [divmod(i, 16) for i in range(len(own))]
            keys = [hashlib.md5("-".join([*([split] if split else []), str(r.block), str(epoch), "1"]).encode()).hexdigest() for r in own]
            assert keys == sorted(keys)
