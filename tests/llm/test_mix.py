import re

import pytest
from pyspark.sql import functions as F

from textmill.llm import mix as M

SMALL = "/root/testdata/sf0.01"


def aims(sizes, share=1.5, most=2):
    """Targets by resharing the excess step by step."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        for s in full or open_:
            target[s] = most * sizes[s] if full else weight[s] * level
        if not full:
            break
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def check(docs, found):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows = [(r.doc_id, r.source, size(r.text)) for r in docs.collect()]
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = aims(sizes)
    assert sorted((r.doc_id, r.size) for r in found if r.doc_id is not None) == sorted((i, n) for i, _, n in rows if i is not None)
    source = {i: s for i, s, _ in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    return taken, want


def test_sources_come_to_their_targets(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    report = M.report(docs)
    found = report.collect()
    taken, want = check(docs, found)
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert sum(r.size and r.taken % r.size != 0 for r in found) <= len(want)
    assert sorted(map(tuple, found)) == sorted(map(tuple, M.report(docs.repartition(5)).collect()))


def test_one_large_source_over_levels(spark):
    docs = spark.range(3_000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), (F.col("id") % 97).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 50 != 1, F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
    )
    taken, want = check(docs, M.report(docs, block=8).collect())
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_fair(spark):
    """Documents of every size give their share on average."""
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (1 + F.col("id") % 5).cast("int")).alias("text"), (F.floor(F.col("id") / 5) % 2).cast("string").alias("source"))
    ratio = F.avg((F.col("taken") / F.col("size")) / (F.col("target") / F.col("source_size")))
    assert all(abs(r.share - 1) < 0.12 for r in M.report(docs).groupBy("size", "source_size").agg(ratio.alias("share")).collect())


def test_odd_rows(spark):
    rows = [
        (1, None, "a", 1), (2, "", "a", 1), (3, "x y", None, 1), (3, "x y", None, 1), (3, "x", None, 1), (None, "z", "b", 1), (4, "w " * 90_000, "b", 1),
        (5, "q q", "", 1), (6, None, None, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int").repartition(4)
    found = M.report(docs).collect()
    assert len(found) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in found)
    out = M.mixed(docs)
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken"]
    assert sum(r.taken for r in out.collect()) == sum(r.taken for r in found)
    assert M.report(docs.limit(0)).count() == 0
    assert {r.taken for r in M.report(docs.filter("doc_id < 3")).collect()} == {0}
