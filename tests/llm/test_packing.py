import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textmill.llm import packing as P
from textmill.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts):
    library = Tokenizer.from_file(PATH)
    return [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sequences_are_sound(rows, window):
    """Gapless from 0, at most a window long; returns the padding of each that is not full."""
    by = defaultdict(list)
    for r in rows:
        assert r.length > 0
        by[r.sequence_id].append((r.offset, r.length))
    short = []
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        if at < window:
            short.append(window - at)
    return short


def documents_are_whole(rows, texts):
    """Each document's pieces are its ids, each once; ``texts`` has one row an id."""
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    ids = dict(zip(texts, ids_of(texts.values())))
    assert set(by) == set(ids)
    for i, parts in by.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == crc(ids[i][at : at + r.length])
            at += r.length
        assert at == len(ids[i])


def test_whole_table(spark):
    rows = QUERIES["op12_packing"](spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    documents_are_whole(rows, texts)
    assert len(sequences_are_sound(rows, P.WINDOW)) <= 1
    assert rows[0].asDict().keys() == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


ODD = {
    1: None, 2: "", 3: "a", 4: "it's <|endoftext|> we'll<|endoftext|>", 5: "  \n\n \t x \x85 \xa0\x1c y\x1f", 6: "日本語 と 😀 ½ ² ª ſ ƀ",
    7: "word " * 60_000, 8: "x" * 20_000, 9: "don't DON'T '' ''s 's  's", 10: "<|endoftext|>", 11: "<|endoftext" * 3, 12: "é" * 999, 13: "tab\there  12a3 ¼½ _-_",
}


def test_odd_texts(spark):
    frame = spark.createDataFrame([(i, t, 5, "z") for i, t in ODD.items()], "doc_id long, text string, length int, ids string").repartition(3)
    rows = P.report(frame, PATH).collect()
    documents_are_whole(rows, ODD)
    assert len(sequences_are_sound(rows, P.WINDOW)) <= 1


def test_repeated_and_null_ids(spark):
    frame = spark.createDataFrame([(None, "same words here")] * 30 + [(7, "same words here")] * 20 + [(7, None)] * 3, "doc_id long, text string").repartition(4)
    rows = P.report(frame, PATH, window=8).collect()
    n = len(ids_of(["same words here"])[0])
    assert sum(r.length for r in rows if r.doc_id is None) == 30 * n
    assert sum(r.length for r in rows) == 50 * n + 3
    assert len(sequences_are_sound(rows, 8)) <= 1


def test_empty_table(spark):
    assert P.report(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_segments_do_not_change_ids(monkeypatch):
    monkeypatch.setattr(P, "SEGMENT", 50)
    draw = random.Random(1)
    encoder = P.Encoder(PATH)
    for _ in range(200):
        text = "".join(draw.choice(["a", "Bc", " ", "  ", "\n", "'s", "1", "é", "!", " the", "<|endoftext|>", "世"]) for _ in range(300))
        assert encoder.encode(text) == np.array(ids_of([text])[0][:-1], "<u4").tobytes()


def test_library_is_used_where_ranks_do_not_say_all():
    encoder = P.Encoder(PATH)
    assert encoder.merger is not None
    encoder.merger = None
    for text in filter(None, ODD.values()):
        assert encoder.encode(text) == np.array(ids_of([text])[0][:-1], "<u4").tobytes()


def test_only_pre_tokens_not_held_are_learned(monkeypatch):
    monkeypatch.setattr(P, "HELD", 6)
    monkeypatch.setattr(P, "LONGEST_HELD", 9)
    encoder, learned = P.Encoder(PATH), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: (learned.append(sorted(new)), learn(new))[1])
    for text in ("one two one", "one three", "a" * 20 + " one", "a" * 20 + " one", "four five six seven", "one"):
        assert encoder.encode(text) == np.array(ids_of([text])[0][:-1], "<u4").tobytes()
    assert learned == [[" one", " two", "one"], [" three"], ["a" * 20], ["a" * 20], [" five", " seven", " six", "four"], ["one"]]


def test_combinations_are_all_that_fill_a_window():
    found = {tuple(c) for c in P.combinations(np.array([2, 3, 5, 6, 7, 10]), 12).tolist()}
    assert found == {(10, 2, 0), (7, 5, 0), (6, 6, 0), (7, 3, 2), (5, 5, 2), (6, 3, 3)}


def test_least_squares_find_an_exact_histogram():
    columns = P.combinations(np.arange(1, 64), 64)
    draw = np.random.default_rng(0)
    histogram = np.zeros(65)
    for j in draw.choice(len(columns), 40, replace=False):
        histogram[columns[j][columns[j] > 0]] += 1_000
    counts = P.repeat_counts(histogram, columns)
    fitted = np.zeros(65)
    for k in range(3):
        np.add.at(fitted, columns[:, k], counts)
    assert (counts >= 0).all() and np.abs(fitted - histogram)[32:].max() < 100


@pytest.mark.parametrize(
    "histogram",
    [{}, {600: 10**9}, {1: 10**9}, {1023: 10**9 + 7, 1: 5}, {513: 1}, {700: 3, 701: 2}, {n: 1 + n * n % 37 for n in range(1, 1024)}, {600: 10**9, 333: 77, 5: 10**8, 1000: 12_345_678}],
)
def test_plans_place_all(histogram):
    plan = P.Plan(histogram)
    placed, used = Counter(), Counter()
    for length, low, high, start, size, _, _ in plan.rows:
        assert 0 <= low < high <= histogram[length] and 0 <= start and start + size <= length
        placed[length] += (high - low) * size
        used[length] += 1
    total = sum(n * c for n, c in histogram.items())
    assert placed == Counter({n: n * c for n, c in histogram.items()})
    assert 0 <= plan.sequences * 1024 - total < 1024
    assert len(plan.rows) < 40_000
