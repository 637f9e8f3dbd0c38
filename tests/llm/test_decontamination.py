import hashlib
import re

import pytest

from textmill.llm import decontamination as D

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans(D.UPPER, D.LOWER)


def words(text):
    return re.findall(D.WORD, (text or "").translate(LOWER))


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    lengths = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in lengths:
            for i in range(len(w) - size + 1):
                got = windows.get(tuple(w[i : i + size]))
                if got:
                    hit |= set(range(i, i + size))
                    found |= got
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_whole_tables_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert any(r[5] for r in expected) and got(D.report(docs, items)) == expected


TEN = "one two three four five six seven eight nine ten"
DOCS = [
    (1, None), (2, ""), (3, TEN.upper()), (3, TEN.upper()), (4, f"zero {TEN}-eleven"), (5, "one two three"),
    (6, "x " * 300_000 + TEN), (None, TEN), (7, "Été, ÉTÉ été"), (8, TEN.replace("five", "5")), (9, "y" * 1_200_000 + " " + TEN),
]
ITEMS = [(10, TEN), (2, f"{TEN} eleven"), (3, "ÉTÉ"), (4, None), (5, " .,"), (None, "three"), (6, "two three"), (6, "two three")]


@pytest.mark.parametrize("block", [D.BLOCK, 2])
def test_odd_rows(spark, block):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert got(D.report(docs, items, block=block)) == brute(DOCS, ITEMS)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, TEN, 5, "a")], "doc_id long, text string, _item_hits long, n_words string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert not D.report(docs, none).first().contaminated
    assert D.report(docs.limit(0), none).count() == 0
    items = spark.createDataFrame([(1, TEN)], "item_id long, text string")
    assert D.report(docs, items).first().contaminated
    assert D.decontaminate(docs, none).columns == ["doc_id", "text", "n_words"]


def test_removal(spark):
    docs = spark.createDataFrame([(1, f"Before, {TEN}! After", "x"), (2, "clean", None)], "doc_id long, text string, lang string")
    items = spark.createDataFrame([(1, TEN)], "item_id long, text string")
    assert got(D.decontaminate(docs, items)) == [(2, "clean", None)]
    assert got(D.decontaminate(docs, items, remove="spans")) == [(1, "Before, ! After", "x"), (2, "clean", None)]
