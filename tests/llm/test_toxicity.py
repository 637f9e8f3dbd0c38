import zlib

import numpy as np

from textmill.llm import toxicity as X

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy_on_whole_table(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    found = {r.doc_id: r for r in X.report(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in found.items())
    assert all(r.predicted == int(r.score >= 0.5) for r in found.values())
    held = [(r.toxic, found[r.doc_id].predicted) for r in labels.collect() if found[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) >= 0.95


def test_held_out_labels_are_never_used(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    other = labels.withColumn("toxic", F.when(X.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda x: sorted((r.doc_id, r.score) for r in X.report(docs, x).collect())
    assert score(labels) == score(other)


def test_isotonic_by_hand():
    at, level = X.isotonic(np.array([1.0, 2.0, 2.0, 3.0, 4.0]), np.array([0, 1, 0, 0, 1]))
    assert at.tolist() == [1, 2, 3, 4] and np.allclose(level, [0, 1 / 3, 1 / 3, 1])


def test_odd_rows(spark):
    rows = [(i, "you are an idiot " * 3 if i % 2 else "a fine day out", 1.0) for i in range(60)]
    rows += [(70, None, 1.0), (71, "", 1.0), (71, "", 1.0), (None, "x" * 3_000_000, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (71, None)], "doc_id long, toxic int")
    found = X.report(docs, labels).collect()
    assert len(found) == 64 and all(0 <= r.score <= 1 for r in found)
    assert {r.predicted for r in found if r.doc_id is not None and r.doc_id < 60 and r.doc_id % 2} == {1}
    assert {r.predicted for r in found if r.doc_id in (70, 71, None)} == {0}
    assert {r.score for r in X.report(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in X.report(docs, labels.filter("toxic = 1")).collect()} == {1.0}
    assert X.report(docs.limit(0), labels).count() == 0
    assert X.without_toxic(docs, labels).columns == ["doc_id", "text"]
