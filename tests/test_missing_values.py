"""Nulls, odd numbers and unknown ids: no row is lost and no size changes the result."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.functions import cleaning
from textmill.operators import chat, documents, encoding, layout, metrics, vocabulary
from textmill.sources import corpus, text_array, token_store


def test_offsets_of_a_null_split(spark):
    rows = [(1, "train", 5), (2, None, 7), (3, None, 2), (4, "val", 1)]
    placed = layout.offsets(spark.createDataFrame(rows, "doc_id long, split string, size int"))
    assert sorted((r.doc_id, r.start, r.row_index, r.shard) for r in placed.collect()) == [(1, 0, 0, 0), (2, 0, 0, 0), (3, 7, 1, 1), (4, 0, 0, 0)] or sorted(
        (r.doc_id, r.start, r.row_index) for r in placed.collect()
    ) == [(1, 0, 0), (2, 0, 0), (3, 7, 1), (4, 0, 0)]


def test_records_without_run_or_iteration(spark):
    rows = [("a", 1, 3.0), ("a", 2, 2.0), (None, 1, 9.0), (None, 2, 8.0), ("a", None, 1.0)]
    records = spark.createDataFrame(rows, "run string, iter long, val_loss double").withColumn("ts", F.timestamp_seconds(F.coalesce("iter", F.lit(0))))
    best = metrics.with_running_best(records)
    assert sorted((r.run or "", r.iter or 0, r.best_val_loss) for r in best.collect()) == [("", 1, 9.0), ("", 2, 8.0), ("a", 0, 1.0), ("a", 1, 1.0), ("a", 2, 1.0)]
    assert metrics.with_elapsed(records).count() == 5


def test_record_has_nine_fields(spark, tmp_path):
    records = metrics.as_records(spark.createDataFrame([("a", 1, 3.0)], "run string, iter int, loss double"))
    assert records.columns == ["run", "ts", *metrics.FIELDS]
    metrics.append_metrics(records, str(tmp_path / "m"))
    assert metrics.read_metrics(spark, str(tmp_path / "m")).first().asDict()["loss"] == 3.0


def test_every_split_is_in_the_metadata(spark):
    sizes = spark.createDataFrame([("dev", 7), ("train", 3), (None, 2)], "split string, tokens long")
    assert layout.metadata(sizes, "n", "p").first()["size"] == {"train": 3, "val": 0, "test": 0, "dev": 7, "": 2}


def test_conversation_is_one_row_whatever_its_turn_numbers(spark):
    rows = [(1, t, "user", f"{t} ") for t in (4094, 4095, 4096, 4097, 10**9, -5)] + [(None, 1, "user", "x"), (2, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.render_conversations(turns).collect()}
    assert set(got) == {1, 2, None} and {r.part for r in got.values()} == {0}
    assert got[1].text.replace("<|user|>", "") == "<|startoftext|>-5 4094 4095 4096 4097 1000000000 <|endoftext|>"


def test_unknown_ids_stop_or_are_marked(spark):
    vocab = spark.createDataFrame([("ab", 256)], "piece string, id int")
    ranks = encoding.vocabulary_ranks(vocab)
    frame = spark.createDataFrame([(1, [500, 65, 256])], "doc_id long, tokens array<int>")
    with pytest.raises(Exception, match="no token has the id 500"):
        encoding.decode(frame, ranks).collect()
    assert encoding.decode(frame, ranks, unknown="replace").first().text == "�Aab"
    assert [w.word for w in encoding.words(frame, ranks, unknown="replace").first().words] == ["�", "A", "ab"]


def test_control_ids_above_a_models_own_tokens(spark):
    ranks = encoding.vocabulary_ranks(spark.createDataFrame([("ab", 256)], "piece string, id int"))
    docs = spark.createDataFrame([(1, "ab<|endoftext|>")], "doc_id long, text string")
    assert encoding.encode_with_ranks(docs, ranks, first_control_id=300).first().tokens == [256, 309]
    with pytest.raises(ValueError):
        encoding.encode_with_ranks(docs, ranks, first_control_id=100)


def test_empty_array_is_one_empty_line(spark, tmp_path):
    path = str(tmp_path / "lines")
    text_array.save_text_array(spark.createDataFrame([], "pos long, value string"), path)
    assert [tuple(r) for r in text_array.load_text_array(spark, path).collect()] == [(0, "")]


def test_part_numbers_are_numbers(spark, tmp_path):
    for number, value in ((99_999, "a\nb"), (100_000, "c"), (100_001, "d")):
        (tmp_path / f"part-{number:05d}-x.txt").write_text(value + "\n")
    rows = text_array.load_text_array(spark, str(tmp_path)).orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]


def test_vocabulary_of_cleaned_text_holds_no_part_of_a_control_token(spark, docs):
    clean = docs.withColumn("text", cleaning.clean_text(F.col("text")))
    pieces = {r.piece for r in vocabulary.piece_counts(clean).collect()}
    assert pieces and not pieces & {"<|", "|>", "|><|", "new", "line", "<|new_line|>"} - {"new", "line"}


def test_clashing_ids_stay_apart(spark):
    one = spark.createDataFrame([(1, "a", "hello there")], "doc_id long, source string, text string")
    two = spark.createDataFrame([(1, "b", "other words")], "doc_id long, source string, text string")
    both = corpus.union_corpora(one, two)
    assert sorted((r.doc_id, r.text) for r in both.collect()) == [(2, "hello there"), (3, "other words")]


def test_second_export_replaces_the_first(spark, tmp_path):
    path = str(tmp_path / "raw")
    frame = lambda split, ids: spark.createDataFrame([(split, 0, 0, ids), (split, 1, len(ids), [7])], "split string, shard int, start long, tokens array<int>")
    token_store.export_raw(frame("old", [9, 9]), path)
    token_store.export_raw(frame("train", [1, 2, 3]), path)
    files = sorted(str(p.relative_to(path)) for p in (tmp_path / "raw").rglob("*.bin"))
    assert [f.split("/")[0] for f in files] == ["train", "train"]
    assert np.concatenate([np.fromfile(f"{path}/{f}", "<u2") for f in files]).tolist() == [1, 2, 3, 7]


def test_random_document_reads_only_ids_to_draw(spark, docs):
    frame = documents.random_document(docs, seed=3)
    assert frame.count() == 1 and frame.first().doc_id == documents.random_document(docs, seed=3).first().doc_id


def test_partitions_follow_the_size_of_the_input(spark, docs, monkeypatch):
    few = corpus.by_document(docs).rdd.getNumPartitions()
    monkeypatch.setattr(corpus, "BYTES_PER_PARTITION", 10_000)
    many = corpus.by_document(docs).rdd.getNumPartitions()
    assert few == 8 < many
