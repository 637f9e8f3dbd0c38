"""Hard negatives by exact integer inner products: Strassen tiles, then mergeable heaps.

Vectors become integers, ``floor(scale * x)``. Anchors and candidates are dealt into blocks of at most about ``BLOCK``
rows, and every anchor block meets every candidate block in a group of its own (a cell). A cell multiplies its tiles
by Strassen's recursion on int64, odd sides padded with zeros, and keeps for each anchor the first few entries
in a heap; heaps of the cells are merged by Spark. The positives come first, from cells inside a label, then the
negatives, whose score window is set by each positive's score. A label that holds a third of all rows has
as many more blocks as it has more rows, so no cell is larger than another.

Rows with a null id, label or vector, or with a null or non-finite component, take no part; nor do rows whose integer vector's
squared length reaches 2**60, so that no score can leave 64 bits. Shorter vectors count as ended by zeros. Higher
scores come first, ties by smaller id. Every row counts on its own: a copy of an anchor, of the same id or not, is
another row, and an anchor that occurs twice gives its result rows twice. An anchor without another row of its label, or without a
negative in a window, gives no row for it. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import stored

SCALE = 256
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100
ANCHOR_MODULUS = 100
BLOCK = 32_768  # rows of a cell's side at most, about
LEAST_BLOCK = 1_024  # blocks are not made smaller for the sake of more tasks
TILE = 1_024  # rows of a tile's side
LEAF = 32  # sides up to this are multiplied directly
LARGEST = float(1 << 60)
EMPTY = np.iinfo(np.int64).min
SALTS = 64


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The int64 product of two matrices by seven half-size products a level."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return np.einsum("ik,kj->ij", a, b)
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    r, c, s = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :c], a[:r, c:], a[r:, :c], a[r:, c:]
    b11, b12, b21, b22 = b[:c, :s], b[:c, s:], b[c:, :s], b[c:, s:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * s), np.int64)
    out[:r, :s] = p1 + p4 - p5 + p7
    out[:r, s:] = p3 + p5
    out[r:, :s] = p2 + p4
    out[r:, s:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The first ``k`` (score, id) entries of each of ``n`` lists; heaps of parts merge to those of the whole."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), EMPTY, np.int64)
        self.ids = np.zeros((n, k), np.int64)

    def floor(self) -> np.ndarray:
        """Per list the score that a later entry has to beat; ``EMPTY`` while there is room."""
        return self.scores[:, -1]

    def merge(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take in entries: list number, score and id of each."""
        if not len(at):
            return
        lists = np.unique(at)
        at = np.concatenate([np.repeat(lists, self.k), at])
        scores = np.concatenate([self.scores[lists].ravel(), scores])
        ids = np.concatenate([self.ids[lists].ravel(), ids])
        real = scores != EMPTY
        at, scores, ids = at[real], scores[real], ids[real]
        order = np.lexsort((ids, -scores, at))
        at, scores, ids = at[order], scores[order], ids[order]
        begins = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        place = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
        first = place < self.k
        self.scores[at[first], place[first]] = scores[first]
        self.ids[at[first], place[first]] = ids[first]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, place = np.nonzero(self.scores != EMPTY)
        return at, self.scores[at, place], self.ids[at, place]


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy().astype(np.int64, copy=False)


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    """The vectors as rows, ended by zeros up to ``width``."""
    lists = table["vector"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy().astype(np.int64, copy=False)
    if len(sizes) and sizes.min() == sizes.max() == width:
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _tiles(left: pa.Table, right: pa.Table):
    """Anchor range, candidate range and score tile of a cell; candidates in the order of their ids."""
    width = max(int(t["width"].to_numpy().max()) for t in (left, right))
    a, b = _matrix(left, width), np.ascontiguousarray(_matrix(right, width).T)
    for c in range(0, b.shape[1], TILE):
        for r in range(0, len(a), TILE):
            yield slice(r, r + TILE), slice(c, c + TILE), strassen(a[r : r + TILE], b[:, c : c + TILE])


def _positive_cell(count: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        heaps = Heaps(len(left), count if len(right) else 1)
        if len(left) and len(right):
            right = right.sort_by([("id", "ascending"), ("row", "ascending")])
            own, rows, ids = _column(left, "row"), _column(right, "row"), _column(right, "id")
            for r, c, scores in _tiles(left, right):
                wanted = (scores > heaps.floor()[r, None]) & (own[r, None] != rows[None, c])
                at, of = np.nonzero(wanted)
                heaps.merge(at + r.start, scores[at, of], ids[c][of])
        at, scores, ids = heaps.entries()
        return pa.table({"row": _column(left, "row")[at], "other": ids, "score": scores})

    return run


def _negative_cell(count: int, low: int, high: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        slots = max((len(x) for x in left["positives"].to_pylist()), default=0) if len(left) else 0
        heaps = [Heaps(len(left), count) for _ in range(slots)]
        if len(left) and len(right):
            right = right.sort_by([("id", "ascending"), ("row", "ascending")])
            label, labels, ids = _column(left, "label"), _column(right, "label"), _column(right, "id")
            # scores of a window, ends included; an absent positive has an empty one
            least = np.full((slots, len(left)), 1, np.int64)
            most = np.zeros((slots, len(left)), np.int64)
            for i, scores in enumerate(left["positives"].to_pylist()):
                for j, score in enumerate(scores):
                    least[j, i], most[j, i] = -((-low * score) // 100), (high * score) // 100
            for r, c, scores in _tiles(left, right):
                other = label[r, None] != labels[None, c]
                for j, heap in enumerate(heaps):
                    bottom = np.maximum(least[j, r], heap.floor()[r] + 1)
                    if (bottom > most[j, r]).all():
                        continue
                    at, of = np.nonzero((scores >= bottom[:, None]) & (scores <= most[j, r, None]) & other)
                    heap.merge(at + r.start, scores[at, of], ids[c][of])
        found = [h.entries() for h in heaps]
        rows = _column(left, "row")
        parts = [pa.table({"row": rows[at], "slot": np.full(len(at), j, np.int32), "other": ids, "score": scores}) for j, (at, scores, ids) in enumerate(found)]
        empty = pa.table({"row": rows[:0], "slot": np.zeros(0, np.int32), "other": rows[:0], "score": rows[:0]})
        return pa.concat_tables([empty, *parts])

    return run


def _cells(anchors: DataFrame, candidates: DataFrame, group: str, block: int):
    """Both sides dealt so that every anchor block of a group meets each of its candidate blocks once."""
    spark = anchors.sparkSession
    tasks = 2 * max(spark.sparkContext.defaultParallelism, 1)
    blocks = lambda n: F.greatest(F.ceil(n / block), F.least(F.ceil(n / LEAST_BLOCK), F.lit(tasks))).cast("int")
    sizes = (
        candidates.groupBy(group)
        .agg(F.count("*").alias("n"))
        .join(anchors.groupBy(group).agg(F.count("*").alias("m")), group)
        .select(F.col(group).alias("_group"), blocks(F.col("n")).alias("k"), F.ceil(F.col("m") / block).cast("int").alias("l"))
        # a group may hold a third of the rows: its size is told to them in parts
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    place = F.xxhash64("row", F.lit(17))

    def dealt(side: DataFrame, own: str, others: str, names: tuple[str, str]) -> DataFrame:
        salted = side.withColumn("_salt", F.pmod(F.xxhash64("row", F.lit(5)), F.lit(SALTS)).cast("int"))
        known = salted.join(sizes, (F.col(group) == F.col("_group")) & (salted["_salt"] == sizes["_salt"]))
        # under names of their own: both sides come from one table
        return known.select(
            *[F.col(c).alias(c) for c in side.columns],
            F.col("_group").alias("_group"),
            F.pmod(place, F.col(own)).cast("int").alias(names[0]),
            F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(names[1]),
        )

    keys = ["_group", "_anchors", "_candidates"]
    left = dealt(anchors, "l", "k", ("_anchors", "_candidates"))
    right = dealt(candidates, "k", "l", ("_candidates", "_anchors"))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


def integers(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(row, id, label, vector, width)`` of the rows that take part; ``row`` tells equal rows apart."""
    x = F.col("_x")
    sound = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf))
    squared = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    return (
        rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("_x"))
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & F.forall(x, sound))
        .select("id", "label", F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("vector"))
        .filter(squared < LARGEST)
        .select(F.monotonically_increasing_id().alias("row"), "id", "label", "vector", F.size("vector").alias("width"))
    )


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK) -> DataFrame:
    """Hard negatives of rows from :func:`integers`, for those of them where ``anchor`` (a condition on ``id``) holds.

    Per anchor and positive, the first ``negatives`` rows of other labels whose score is at least ``low`` and at
    most ``high`` hundredths of the positive's.
    """
    held = stored(rows, "vectors")
    anchors = held.filter(anchor)
    first = lambda *keys: Window.partitionBy(*keys).orderBy(F.desc("score"), "other")
    near = (
        _cells(anchors, held, "label", block)
        .applyInArrow(_positive_cell(positives), "row long, other long, score long")
        .withColumn("slot", F.row_number().over(first("row")) - 1)
        .filter(F.col("slot") < positives)
    )
    near = stored(near, "positives")
    scores = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("slot", "score")))["score"].alias("positives"))
    asked = anchors.join(scores, "row").withColumn("everything", F.lit(0))
    found = (
        _cells(asked, held.withColumn("everything", F.lit(0)), "everything", block)
        .applyInArrow(_negative_cell(negatives, low, high), "row long, slot int, other long, score long")
        .withColumn("rank", F.row_number().over(first("row", "slot")))
        .filter(F.col("rank") <= negatives)
    )
    pairs = near.join(anchors.select("row", F.col("id").alias("anchor_id")), "row").select(
        "row", "slot", "anchor_id", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return found.join(pairs, ["row", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def report(table: DataFrame, block: int = BLOCK) -> DataFrame:
    """Mined with the rows whose ``vec_id`` is divisible by 100 as anchors; every seventh id has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(integers(table.withColumn("label", label)), F.col("id") % ANCHOR_MODULUS == 0, block=block)


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * c.x[i])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.r <> c.r WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, other) AS slot FROM s WHERE same) WHERE slot <= 5
), n AS (
  SELECT p.anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.slot ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
