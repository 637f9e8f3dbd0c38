from pyspark.sql import functions as F

from textmill.llm import pii, sampling, toxicity


def hot(spark):
    """One id holds 5,000 of 6,000 rows."""
    rows = spark.range(6_000).select(F.when(F.col("id") < 5_000, 1).otherwise(F.col("id")).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    return rows.repartition(6)


def test_sample_is_bounded_by_rows(spark):
    docs = hot(spark)
    few = sampling.one_of_each(sampling.by_hash(docs, "doc_id", 400), "doc_id", "text").collect()
    assert 300 < len(few) < 500 and len({r.doc_id for r in few}) == len(few)
    again = sampling.one_of_each(sampling.by_hash(docs.repartition(3), "doc_id", 400), "doc_id", "text").collect()
    assert sorted(few) == sorted(again)
    everything = sampling.one_of_each(sampling.by_hash(docs, "doc_id", 2_000), "doc_id", "text")
    assert everything.count() == 1_001


def test_operators_use_one_row_of_an_id(spark, monkeypatch):
    docs, seen = hot(spark), []
    monkeypatch.setattr(pii, "labelled_windows", lambda passages: seen.append(passages) or ([], []))
    monkeypatch.setattr(pii.Tagger, "train", lambda self, *a, **k: self)
    pii.train(docs, most=2_000)
    assert len(seen[0]) == 1_001
    labels = docs.select("doc_id", F.lit(1).alias("toxic")).distinct()
    rows = toxicity.training_rows(docs, labels, 2_000)
    assert rows.count() <= 1_001 and rows.filter("toxic IS NULL OR fold IS NULL").isEmpty()
