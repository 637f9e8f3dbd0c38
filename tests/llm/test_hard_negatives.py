import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm import hard_negatives as H

SMALL = "/root/testdata/sf0.001"
KIND = "vec_id long, label int, embedding array<float>, score string, row string"


def brute(rows):
    """Every pair of rows, by Python integers."""
    used = []
    for i, label, x in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        x = [math.floor(256 * float(c)) for c in x]
        if sum(float(c) * c for c in x) < H.LARGEST:
            used.append((i, int(math.fmod(label + 1, 10)) if i % 7 == 0 else label, x))
    out = []
    for a, (i, label, x) in enumerate(used):
        if i % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), j, other) for b, (j, other, y) in enumerate(used) if b != a]
        near = sorted(s[:2] for s in scored if s[2] == label)[:5]
        far = sorted(s[:2] for s in scored if s[2] != label)
        for p, j in near:
            inside = [(s, k) for s, k in far if 80 * -p <= 100 * -s <= 100 * -p][:5]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(inside, 1)]
    return sorted(out)


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 64, 5), (70, 64, 130), (129, 33, 67), (200, 100, 90)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    draw = np.random.default_rng(m)
    a, b = draw.integers(-(2**27), 2**27, (m, k)), draw.integers(-(2**27), 2**27, (k, n))
    assert (H.strassen(a, b, 8) == (a.astype(object) @ b.astype(object))).all()
    assert (H.strassen(a, b) == a @ b).all()


def test_strassen_wraps_back_into_range():
    """Sums inside the recursion may leave 64 bits where the product does not."""
    a = np.full((64, 64), 2**28 + 2**27)
    assert 64 * int(a[0, 0]) ** 2 > 1 << 63
    b = a * np.where(np.arange(64) % 2, -1, 1)[:, None]
    assert (H.strassen(a, b, 4) == 0).all()


def test_heaps_merge_like_sorting():
    draw = random.Random(3)
    entries = [(draw.randrange(4), draw.randrange(6), i) for i in range(300)]
    heaps = H.Heaps(4, 5)
    for at in range(0, 300, 37):
        heaps.merge(*map(np.array, zip(*entries[at : at + 37])))
    found = sorted(zip(*(x.tolist() for x in heaps.entries())))
    assert found == sorted(e for k in range(4) for e in sorted((x for x in entries if x[0] == k), key=lambda x: (-x[1], x[2]))[:5])


@pytest.mark.parametrize("block", [H.BLOCK, 40])
def test_whole_table(spark, block):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    expected = brute([(r.vec_id, r.label, r.embedding) for r in table.collect()])
    assert expected and got(H.report(table, block)) == expected


def rows_of_a_hot_label():
    draw = random.Random(7)
    vector = lambda n=6: [draw.uniform(-0.3, 1.0) for _ in range(n)]
    rows = [(i, 3 if i % 3 else i % 10, vector()) for i in range(600)]
    rows += [(i, i % 10, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(600, 800)]  # ties
    return rows


ODD = [
    (None, 1, [0.5, 0.5]), (100, None, [0.5, 0.5]), (101, 1, None), (102, 1, [0.5, None]), (103, 1, [0.5, math.nan]), (104, 1, [math.inf, 0.5]),
    (200, 4, [0.5, 0.5]), (200, 4, [0.5, 0.5]), (201, 4, [0.5, 0.5]), (202, 5, [0.5, 0.45, 9.0]), (205, 5, [0.5]), (206, 5, []), (300, 6, [0.9, 0.9]),
    (207, 5, [0.5, 0.45]), (207, 5, [0.5, 0.45]), (208, -3, [0.4, 0.4]), (209, 4, [-0.5, -0.5]), (400, 8, [-1.0, 0.25]), (401, 8, [0.3, -0.3]),
    (500, 4, [3e38, 1.0]), (501, 4, [0.49, 0.49, 0.0]), (-100, 4, [0.25, 0.26]), (0, 4, [0.3, 0.3]), (210, 7, [0.0, 0.0]), (211, 5, [0.001, 0.002]),
]


@pytest.mark.parametrize("rows", [ODD, rows_of_a_hot_label()], ids=["odd", "hot"])
def test_odd_rows(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], KIND).repartition(3)
    assert got(H.report(frame, 64)) == brute([tuple(r) for r in frame.select("vec_id", "label", "embedding").collect()])


def test_empty_table(spark):
    assert got(H.report(spark.createDataFrame([], KIND))) == []
    assert got(H.report(spark.createDataFrame([(1, 2, [0.5], "", "")], KIND))) == []


def test_other_windows(spark):
    """The operator's own parameters: other anchors, window and counts."""
    table = H.integers(spark.read.parquet(f"{SMALL}/embeddings.parquet").limit(200))
    found = H.mine(table, F.col("id") < 20, positives=2, negatives=3, low=50, high=90).collect()
    assert found and all(50 * r.positive_score <= 100 * r.negative_score <= 90 * r.positive_score and r["rank"] <= 3 for r in found)
    assert {r.anchor_id for r in found} <= set(range(20))
