"""Rank tables are looked up where pieces and ids are: nothing is sorted as rows of pieces."""

from pyspark.sql import functions as F

from textmill.operators import encoding


def test_ranks_and_decoding_make_no_rows_of_pieces(spark):
    docs = spark.createDataFrame([(1, "ab abc é"), (2, None), (3, ""), (4, "ab " * 50)], "doc_id long, text string")
    ranks = encoding.vocabulary_ranks(spark.createDataFrame([("ab", 256)], "piece string, id int"))
    encoded = encoding.encode_with_ranks(docs, ranks)
    text = encoding.decode(encoded, ranks)
    for frame in (encoded, text):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "HashJoin" not in plan and "SortMergeJoin" not in plan
    assert {r.doc_id: r.text for r in text.collect()} == {1: "ab abc é", 2: "", 3: "", 4: "ab " * 50}
    tokens = {r.doc_id: r.tokens for r in encoded.collect()}
    assert tokens[1] == [256, 32, 256, 99, 32, 0xC3, 0xA9] and tokens[2] == tokens[3] == []


def test_lookup_in_parts_and_by_join_agree(spark, monkeypatch):
    rows = [(i % 7 if i % 5 else None, "ab é" * (i % 4) + f" x{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ranks = encoding.vocabulary_ranks(spark.createDataFrame([("ab", 256), (" x", 257)], "piece string, id int"))

    def both():
        encoded = encoding.encode_with_ranks(docs, ranks)
        return encoded.collect(), encoding.decode(encoded, ranks).collect(), encoding.words(encoded, ranks).collect()

    whole = both()
    monkeypatch.setattr(encoding, "LOOKED_UP_AT_ONCE", 3)
    parts = both()
    monkeypatch.setattr(encoding, "_small", lambda *_: None)
    joined = both()
    for one, two, three in zip(whole, parts, joined):
        assert sorted(map(repr, one)) == sorted(map(repr, two)) == sorted(map(repr, three))


def test_unknown_ids(spark):
    ranks = encoding.vocabulary_ranks(spark.createDataFrame([("ab", 256)], "piece string, id int"))
    frame = spark.createDataFrame([(1, [97, None, 900, 256]), (2, None)], "doc_id long, tokens array<int>")
    text = encoding.decode(frame, ranks, unknown="replace")
    assert {r.doc_id: r.text for r in text.collect()} == {1: "a�ab", 2: ""}
    words = encoding.words(frame, ranks, unknown="replace").select("doc_id", F.col("words")["word"].alias("w"))
    assert {r.doc_id: r.w for r in words.collect()} == {1: ["a", "�", "ab"], 2: []}


def test_vocabulary_makes_no_rows_of_pieces(spark, tmp_path, monkeypatch):
    """In place and by a join: odd, null, empty and long texts, repeated and null ids, null ids of pieces."""
    texts = ["ab abc é日😀", None, "", "ab " * 50, "<|tab|>ab<|endoftext|>", " \n\t x", "zz" * 40, "ab é"]
    rows = [(i % 13 if i % 5 else None, texts[i % 8] and texts[i % 8] * (1 + i % 2)) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    vocab = spark.createDataFrame([("ab", 256), (" ab", 257), ("é", None), ("日", 258)], "piece string, id int")
    monkeypatch.setattr(encoding, "STRETCH_CHARACTERS", 60)
    for unknown in ("bytes", "token"):

        def encoded(joined_bytes):
            monkeypatch.setattr(encoding, "JOINED_BYTES", joined_bytes)
            return encoding.encode_with_vocabulary(docs, vocab, 300, unknown=unknown)

        joined, here = encoded(1 << 20), encoded(0)
        plan = here._jdf.queryExecution().executedPlan().toString()
        assert "HashJoin" not in plan and "SortMergeJoin" not in plan
        monkeypatch.setattr(encoding, "LOOKED_UP_AT_ONCE", 1 << 20 if unknown == "token" else 3)
        parts = encoded(0)
        want = sorted(map(repr, joined.collect()))
        assert len(want) == 14 and sorted(map(repr, here.collect())) == want == sorted(map(repr, parts.collect()))


def test_vocabulary_with_a_piece_twice_is_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(encoding, "JOINED_BYTES", 0)
    spark.createDataFrame([(1, "ab c")], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    vocab = spark.createDataFrame([("ab", 256), ("ab", 257)], "piece string, id int")
    found = encoding.encode_with_vocabulary(spark.read.parquet(str(tmp_path / "docs")), vocab, 300)
    assert found.first().tokens == [256, 257, 32, 99]
