"""Pieces, vocabulary and encoding against ``regex`` and ``tiktoken``."""

import base64
import collections

import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from textmill import tables
from textmill.functions import control, pieces
from textmill.operators import encoding, vocabulary
from textmill.sources import ranks as rank_files

public_tokenizers = pytest.importorskip("public_tokenizers")

HARD = [
    "it's   we'LL\n\n  don't 12345 ½ x\t\ty  ",
    "  leading",
    "trailing   ",
    "",
    "…!!!\r\n\r\n  'S ſ a'ſ",
    "日本語 é́ 👩‍👩‍👧 <|tab|>",
    "a  b \x1c c",
]


@pytest.mark.parametrize("name", ["gpt2", "gpt4"])
def test_pieces_equal_regex(texts, docs, name):
    values = HARD + [r.text for r in docs.collect()]
    got = texts(values, pieces.split_pieces(F.col("text"), name))
    # Python's regex module takes U+001C for a blank, the Unicode property does not
    want = [
        regex.findall(tables.SPLIT_PATTERNS[name].replace(r"\s", r"\p{White_Space}")
                      .replace(r"\S", r"\P{White_Space}"), v)
        for v in values
    ]
    assert got == want
    assert ["".join(p) for p in got] == values


def test_pieces_keep_control_tokens_whole(texts):
    cut = pieces.split_pieces_with_control(F.col("text"))
    got = texts(["a.<|tab|><|user|>b  <|endoftext|>", "<|tab|>", "x <| y", ""], cut)
    assert got == [
        ["a", ".", "<|tab|>", "<|user|>", "b", "  ", "<|endoftext|>"],
        ["<|tab|>"],
        ["x", " <|", " y"],
        [],
    ]


def test_vocabulary_equals_counter(docs):
    room, size = 300, 300 + 256 + 10
    rows = vocabulary.build_vocabulary(vocabulary.piece_counts(docs), size).collect()
    pattern = tables.SPLIT_PATTERNS["gpt2"]
    counts = collections.Counter(p for r in docs.collect() for p in regex.findall(pattern, r.text))
    counts = {p: n for p, n in counts.items() if len(p.encode()) <= 32}
    counts["AI"] = counts.get("AI", 0)
    order = sorted(counts, key=lambda p: (p != "AI", -counts[p], p.encode()))[:room]
    order.sort(key=lambda p: (-counts[p], p.encode()))
    assert {r.piece: r.id for r in rows} == {p: 256 + i for i, p in enumerate(order)}
    assert control.ids(vocabulary.control_start(size))["<|endoftext|>"] == size - 1


def test_vocabulary_without_room_is_refused(docs):
    with pytest.raises(ValueError):
        vocabulary.build_vocabulary(vocabulary.piece_counts(docs), 266)


@pytest.fixture(scope="module")
def ranks(spark):
    return rank_files.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken")).cache()


@pytest.fixture(scope="module")
def encoder():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own",
        pat_str=tables.SPLIT_PATTERNS["gpt2"],
        mergeable_ranks=table,
        special_tokens=control.ids(max(table.values()) + 1),
    )


@pytest.fixture(scope="module")
def hard(spark, docs):
    special = HARD + ["x<|endoftext|>y", "<|tab|>" * 3, "﻿", "z" * 500, "x" * 40 + "é" * 99]
    rows = [(100_000 + i, t) for i, t in enumerate(special)]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.select("doc_id", "text").unionByName(extra).cache()


def test_encode_equals_tiktoken(hard, ranks, encoder):
    want = {r.doc_id: encoder.encode(r.text, allowed_special="all") for r in hard.collect()}
    got = {r.doc_id: r.tokens for r in encoding.encode_with_ranks(hard, ranks).collect()}
    assert got == want
    counts = vocabulary.piece_counts(hard)
    dictionary = encoding.piece_dictionary(counts, ranks, rows=500).cache()
    assert dictionary.count() == 500
    again = encoding.encode_with_ranks(hard, ranks, dictionary=dictionary)
    assert {r.doc_id: r.tokens for r in again.collect()} == want


def test_encode_does_not_depend_on_partitions(hard, ranks):
    found = [
        sorted(
            encoding.encode_with_ranks(
                hard.repartition(n, "doc_id"), ranks, partitioned=True
            ).collect()
        )
        for n in (1, 4, 16)
    ]
    assert found[0] == found[1] == found[2]


def test_decode_and_words(hard, ranks, encoder):
    encoded = encoding.encode_with_ranks(hard, ranks).cache()
    text = {r.doc_id: r.text for r in hard.collect()}
    assert {r.doc_id: r.text for r in encoding.decode(encoded, ranks).collect()} == text
    for row in encoding.words(encoded, ranks).collect():
        ids = encoder.encode(text[row.doc_id], allowed_special="all")
        assert [(w.id, w.word) for w in row.words] == [(i, encoder.decode([i])) for i in ids]


def test_decode_of_broken_bytes(spark, ranks, encoder):
    ids = encoder.encode("é日")[:-1] + [encoder.encode("é")[0], 0]
    frame = spark.createDataFrame([(1, ids), (2, [])], "doc_id long, tokens array<int>")
    got = {r.doc_id: r.text for r in encoding.decode(frame, ranks).collect()}
    assert got == {1: encoder.decode(ids), 2: ""}


def test_repeated_rank_is_refused(hard, spark):
    table = spark.createDataFrame([(b"a", 0), (b"a", 1)], "token binary, id int")
    with pytest.raises(ValueError):
        encoding.encode_with_ranks(hard, table)


def test_byte_mode_round_trip_and_sizes(hard):
    vocab = vocabulary.build_vocabulary(vocabulary.piece_counts(hard), 700).cache()
    encoded = encoding.encode_with_vocabulary(hard, vocab, 700).cache()
    table = encoding.vocabulary_ranks(vocab)
    back = encoding.decode(encoded, table, first_control_id=690)
    text = {r.doc_id: r.text for r in hard.collect()}
    assert {r.doc_id: r.text for r in back.collect()} == text
    sizes = {r.doc_id: r["size"] for r in encoding.vocabulary_sizes(hard, vocab, size=700).collect()}
    assert sizes == {r.doc_id: len(r.tokens) for r in encoded.collect()}
    ends = encoding.add_document_ends(encoded, 690).filter("doc_id = 100003").first()
    assert ends.tokens == [692, 699] and ends["size"] == 2


def test_large_vocabulary_is_joined_without_broadcast(hard, monkeypatch):
    vocab = vocabulary.build_vocabulary(vocabulary.piece_counts(hard), 700).cache()
    want = sorted(encoding.encode_with_vocabulary(hard, vocab, 700).collect())
    monkeypatch.setattr(vocabulary.checked_broadcast, "__defaults__", (0,))
    shuffled = encoding.encode_with_vocabulary(hard, vocab, 700)
    assert sorted(shuffled.collect()) == want


def test_id_width(spark):
    def width(ids):
        frame = spark.createDataFrame([(ids,)], "tokens array<int>")
        return tuple(vocabulary.id_width(frame).first())

    assert width([1, 65535]) == (65535, "uint16")
    assert width([65536]) == (65536, "uint32")
    assert width([]) == (0, "uint16")


def test_rank_files_round_trip(spark, tmp_path, ranks):
    path = str(tmp_path / "ranks")
    rank_files.write_ranks(ranks, path)
    assert rank_files.read_ranks(spark, path).exceptAll(ranks).isEmpty()


def test_encoding_plan_shuffles_text_once(docs):
    vocab = vocabulary.build_vocabulary(vocabulary.piece_counts(docs), 700).cache()
    vocab.count()
    plan = encoding.encode_with_vocabulary(docs, vocab, 700)._jdf.queryExecution()
    text = plan.executedPlan().toString().split("BroadcastExchange")[0]
    assert text.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in text
