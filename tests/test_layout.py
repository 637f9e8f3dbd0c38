import math

import pytest
from pyspark.sql import functions as F

from textmill.operators import layout, ordering


def frame(spark, count, step=1):
    rows = [(i * step, "train", (i * 7) % 5 + 1) for i in range(count)]
    return spark.createDataFrame(rows, "doc_id long, split string, size int")


@pytest.mark.parametrize("count, want", [(1, 1), (999, 1), (1000, 1), (1001, 2), (0, 0)])
def test_exact_split_size(spark, count, want):
    docs = frame(spark, count).drop("split")
    got = layout.exact_split(docs, seed=1)
    assert got.filter("split = 'val'").count() == want
    assert got.count() == count


def test_exact_split_does_not_depend_on_partitions(spark):
    found = [
        {
            r.doc_id
            for r in layout.exact_split(
                frame(spark, 2_000).drop("split").repartition(n), 0.05, seed=9
            )
            .filter("split = 'val'")
            .collect()
        }
        for n in (1, 4, 16)
    ]
    assert len(found[0]) == 100 and found[0] == found[1] == found[2]


@pytest.mark.parametrize(
    "count, shards", [(0, 1), (1, 1), (2, 1), (3, 2), (1000, 512), (1024, 512), (1025, 1024)]
)
def test_shard_count(spark, count, shards):
    row = spark.range(1).select(layout.shard_count(F.lit(count)).alias("k")).first()
    assert row.k == shards


@pytest.mark.parametrize("count, per_bucket", [(1, 10), (13, 4), (700, 50)])
@pytest.mark.parametrize("step", [1, 2**45])
def test_offsets_are_dense(spark, count, per_bucket, step):
    placed = layout.offsets(frame(spark, count, step), rows_per_bucket=per_bucket)
    rows = placed.orderBy("doc_id").collect()
    total = 0
    for index, row in enumerate(rows):
        assert (row.start, row.row_index) == (total, index)
        total += row["size"]
    sizes = [sum(r.shard == s for r in rows) for s in range(rows[-1].shard + 1)]
    assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
    assert [r.shard for r in rows] == sorted(r.shard for r in rows)


def test_crowded_ids_are_spread_over_buckets(spark):
    rows = [(i,) for i in range(3_000)] + [(2**62 - i,) for i in range(3)]
    ids = spark.createDataFrame(rows, "doc_id long")
    counts = (
        ordering.with_range_bucket(ids, "doc_id", rows_per_bucket=100)
        .groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        .orderBy("bucket")
        .collect()
    )
    assert max(c.n for c in counts) <= 400
    assert all(a.hi < b.lo for a, b in zip(counts, counts[1:]))


def test_bounds_of_crowded_and_far_ids(spark):
    """Cells with too many rows are counted again, over the whole range of a long."""
    rows = [(i,) for i in range(1_000)] + [(-(2**63) + i,) for i in range(40)] + [(2**63 - 1,), (None,)]
    ids = spark.createDataFrame(rows, "doc_id long")
    bounds = ordering.range_bounds(ids, "doc_id", rows_per_bucket=25)
    assert 40 <= len(bounds) <= 90 and bounds == sorted(bounds)
    near = spark.range(1_000).withColumnRenamed("id", "doc_id")
    counts = (
        ordering.with_range_bucket(near, "doc_id", rows_per_bucket=25).groupBy("bucket").count()
    ).collect()
    assert 36 <= len(counts) <= 41 and max(c["count"] for c in counts) <= 40


def test_running_totals_with_and_without_broadcast(spark):
    data = frame(spark, 300).withColumn("b", F.floor(F.col("doc_id") / 11))
    results = [
        ordering.running_totals(
            data, {"t": F.col("size")}, ["doc_id"], "b", ["split"], few_buckets=few
        ).collect()
        for few in (True, False)
    ]
    assert sorted(results[0]) == sorted(results[1])


def test_metadata_has_three_splits(spark):
    sizes = layout.split_sizes(frame(spark, 10), text=None)
    row = layout.metadata(sizes, "name", "part", 2).first()
    assert row["size"] == {"train": 30, "val": 0, "test": 0}
    assert (row.training_part, row.name, row.multiplier) == ("part", "name", 2.0)


def test_repeat_documents(spark):
    rows = [(i, s) for s in ("wikipedia", "other", "half", "none") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    repeated = layout.repeat_documents(
        docs, {"wikipedia": 1.0, "half": 0.5, "none": 0.0}, default=2.25
    )
    counts = {r.source: r["count"] for r in repeated.groupBy("source").count().collect()}
    assert counts["wikipedia"] == 400 and "none" not in counts
    assert 140 < counts["half"] < 260
    assert 840 < counts["other"] < 960
    default = layout.repeat_documents(docs)
    counts = {r.source: r["count"] for r in default.groupBy("source").count().collect()}
    assert counts == {"wikipedia": 400, "other": 1600, "half": 1600, "none": 1600}


def test_mix_report_of_nothing(spark):
    empty = spark.createDataFrame([], "source string, size int")
    assert layout.mix_report(empty).filter("source != 'Total'").count() == 0


def test_hash_fraction_range(spark):
    share = ordering.hash_fraction(ordering.hash_key("id", seed=3))
    row = spark.range(5_000).select(F.min(share), F.max(share), F.avg(share)).first()
    assert 0 <= row[0] and row[1] < 1 and math.isclose(row[2], 0.5, abs_tol=0.03)
