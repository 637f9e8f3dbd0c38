"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a lexicon (fixed words, and words and word beginnings learned from
labelled rows), how near its hits stand to second-person words, rates of capitals, punctuation and
obfuscation, length. Lexicon and trees are fitted on at most ``SAMPLE`` labelled rows: the lexicon by
document counts on Spark, the trees on the sample's feature rows. Both are cross-fitted in two folds, so that neither
the trees nor the calibration see features or scores made from a row's own label. Every document is scored.

Null and empty texts have zero features and are scored like any other. Rows without a label, a null id or a null
label are never learned from; of several labels of an id the largest counts. Repeated documents
are scored each on its own. Without labelled rows the score is 0, with one class it is that class's
rate. Other columns are kept; a column named ``score`` is replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.llm import sampling, words
from textmill.session import stored

SAMPLE = 20_000
#: Learned lexicon: most entries, fewest toxic documents and least log ratio of an entry.
ENTRIES, SUPPORT, RATIO = 4_000, 4, 2.5
PREFIXES = (4, 5, 6)
#: Trees: rounds, depth, bins, step, least weight of a leaf.
ROUNDS, DEPTH, BINS, STEP, LEAF = 60, 3, 32, 0.2, 2.0
CUT = 0.5
CHUNK = 4 << 20
MEMO = 400_000

# Insults and second-person words of four languages.
INSULTS = (
    "idiot idiots moron morons stupid dumb fool loser losers pathetic worthless trash garbage scum clown "
    "disgusting jerk ugly filthy vermin imbecile cretin pig bastard hate kill die "
    "trottel dumm dummkopf blöd arschloch abschaum schwein versager "
    "idiote imbécile stupide crétin connard ordure salaud minable "
    "idiota estúpido estúpida imbécil tonto basura asqueroso inútil cabrón"
).split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".split()
WORD = re.compile(r"[^\W\d_]+")
NAMES = (
    "fixed", "learned", "any", "strength", "strongest", "second", "near", "capitals", "exclaims",
    "questions", "punctuation", "symbols", "digits", "inner", "stretched", "length",
)
_LETTER, _UPPER, _DIGIT, _SPACE, _EXCLAIM, _QUESTION, _POINT, _SYMBOL = range(8)


def _classes() -> np.ndarray:
    kind = np.full(256, _SYMBOL, np.uint8)
    kind[0x80:] = _LETTER
    kind[0x61:0x7B] = _LETTER
    kind[0x41:0x5B] = _UPPER
    kind[0x30:0x3A] = _DIGIT
    kind[[0x20, *range(0x09, 0x0E)]] = _SPACE
    kind[[ord(c) for c in ".,;:'\"()-"]] = _POINT
    kind[ord("!")] = _EXCLAIM
    kind[ord("?")] = _QUESTION
    return kind


CLASS = _classes()


class _Weights(dict):
    """Word to what it counts for: 0, its weight in the lexicon, or -1 for second-person words."""

    def __init__(self, learned: dict[str, float]):
        super().__init__()
        self.learned, self.fixed, self.second = learned, set(INSULTS), set(SECOND_PERSON)

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMO:
            self.clear()
        found = -1.0 if word in self.second else 0.0
        weight = max((self.learned.get(k, 0.0) for k in keys_of(word)), default=0.0)
        if weight > 0:
            found = weight + (100.0 if word in self.fixed else 0.0)
        elif word in self.fixed:
            found = 100.0
        self[word] = found
        return found


def keys_of(word: str) -> list[str]:
    """The word itself (marked as whole) and its beginnings."""
    return [word + "$"] + [word[:n] for n in PREFIXES if len(word) >= n]


def features_of(data: bytes, text: str, weights: _Weights) -> list[float]:
    """One row of ``NAMES``."""
    found = np.fromiter(map(weights.__getitem__, WORD.findall(text.lower())), np.float64)
    n = max(1, len(found))
    hit = np.flatnonzero(found > 0)
    strength = found[hit] % 100.0
    second = np.flatnonzero(found < 0)
    near = 0
    if len(hit) and len(second):
        place = np.searchsorted(second, hit)
        before = hit - second[np.maximum(place - 1, 0)]
        after = second[np.minimum(place, len(second) - 1)] - hit
        near = int(((np.abs(before) <= 4) | (np.abs(after) <= 4)).sum())
    kind = CLASS[np.frombuffer(data, np.uint8)]
    of = np.bincount(kind, minlength=8)
    letters = max(1, int(of[_LETTER] + of[_UPPER]))
    size = max(1, len(kind))
    inner = stretched = 0
    if len(kind) > 2:
        letter = kind <= _UPPER
        odd = (kind == _DIGIT) | (kind == _SYMBOL) | (kind == _EXCLAIM)
        inner = int((letter[:-2] & odd[1:-1] & letter[2:]).sum())
        raw = np.frombuffer(data, np.uint8)
        same = raw[1:] == raw[:-1]
        stretched = int((same[1:] & same[:-1] & letter[2:]).sum())
    return [
        float((found >= 100).sum()) / n, float((strength > 0).sum()) / n, float(np.log1p(len(hit))),
        float(strength.sum()) / n, float(strength.max()) if len(hit) else 0.0, len(second) / n,
        near / n, of[_UPPER] / letters, of[_EXCLAIM] / size, of[_QUESTION] / size, of[_POINT] / size,
        of[_SYMBOL] / size, of[_DIGIT] / size, inner / n, stretched / n, float(np.log1p(len(kind))),
    ]


def _grow(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A complete tree over binned features: feature and bin of each inner node, value of each leaf."""
    inner = (1 << DEPTH) - 1
    feature, bound = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
    node = np.zeros(len(x), np.int64)
    for depth in range(DEPTH):
        first, width = (1 << depth) - 1, 1 << depth
        best = np.full(width, 1e-6)
        for f in range(x.shape[1]):
            cell = (node - first) * BINS + x[:, f]
            g = np.bincount(cell, gradient, width * BINS).reshape(width, BINS)
            h = np.bincount(cell, hessian, width * BINS).reshape(width, BINS)
            left_g, left_h = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
            all_g, all_h = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - all_g**2 / (all_h + 1)
            gain[(left_h < LEAF) | (right_h < LEAF)] = 0
            at = gain.argmax(1)
            most = gain[np.arange(width), at]
            better = most > best
            best[better] = most[better]
            feature[first : first + width][better] = f
            bound[first : first + width][better] = at[better]
        node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > bound[node])
    leaf = node - inner
    value = -np.bincount(leaf, gradient, 1 << DEPTH) / (np.bincount(leaf, hessian, 1 << DEPTH) + 1)
    return feature, bound, value * STEP


class Trees:
    """Boosted trees for the logistic loss."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        marks = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, f], marks)) for f in range(x.shape[1])]
        binned, self.trees = self._binned(x), []
        rate = (y.sum() + 0.5) / (len(y) + 1)
        self.start = float(np.log(rate / (1 - rate)))
        raw = np.full(len(y), self.start)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-raw))
            tree = _grow(binned, p - y, np.maximum(p * (1 - p), 1e-6))
            self.trees.append(tree)
            raw += self._tree(binned, tree)
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], 1)

    @staticmethod
    def _tree(x: np.ndarray, tree: tuple) -> np.ndarray:
        feature, bound, value = tree
        node, row = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[row, feature[node]] > bound[node])
        return value[node - len(feature)]

    def raw(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        return self.start + sum(self._tree(binned, t) for t in self.trees)


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: knots and the calibrated probability at each."""
    order = np.argsort(raw, kind="stable")
    at, first = np.unique(raw[order], return_index=True)
    count = np.diff(np.append(first, len(raw))).astype(float)
    mean = np.add.reduceat(y[order].astype(float), first) / count
    pools: list[list[float]] = []  # mean, weight, knots
    for m, c in zip(mean, count):
        pools.append([m, c, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m2, c2, k2 = pools.pop()
            m1, c1, k1 = pools.pop()
            pools.append([(m1 * c1 + m2 * c2) / (c1 + c2), c1 + c2, k1 + k2])
    return at, np.concatenate([np.full(int(k), m) for m, _, k in pools])


class Model:
    """What a task needs for a score."""

    def __init__(self, learned: dict[str, float], trees: Trees | None, knots: np.ndarray, levels: np.ndarray):
        self.learned, self.trees, self.knots, self.levels = learned, trees, knots, levels

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), float(self.levels[0]))
        return np.clip(np.interp(self.trees.raw(x), self.knots, self.levels), 0.0, 1.0)


def held_out() -> F.Column:
    """Whether a document is never learned from: crc32 of its id as text, a multiple of 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _texts(batch: pa.RecordBatch):
    column = batch.column(batch.schema.names.index("text"))
    for a, b in words.slices(words.byte_sizes(column), CHUNK):
        part = batch.slice(a, b - a)
        yield part, words.as_bytes(part.column(batch.schema.names.index("text")))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """``(text, toxic, fold)`` of the labelled sample; written, as it is read twice."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("_toxic"))
    )
    few = sampling.by_hash(known, "doc_id", most).withColumnRenamed("doc_id", "_id")
    found = docs.select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("_id"))
    joined = sampling.one_of_each(found, "doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("_id"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)).cast("int")
    return stored(joined.select("text", F.col("_toxic").cast("int").alias("toxic"), fold.alias("fold")), "training")


def _key_counts(batches):
    for batch in batches:
        names = batch.schema.names
        for part, texts in _texts(batch):
            toxic = part.column(names.index("toxic")).to_pylist()
            fold = part.column(names.index("fold")).to_pylist()
            total: dict[str, list[int]] = {}
            for data, y, f in zip(texts, toxic, fold):
                seen = {k for w in set(WORD.findall(data.decode().lower())) for k in keys_of(w)}
                for k in seen:
                    total.setdefault(k, [0, 0, 0, 0])[2 * f + (y > 0)] += 1
            rows = list(total.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string())] + [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)],
                names=["key", "clean0", "toxic0", "clean1", "toxic1"],
            )


def lexicons(rows: DataFrame) -> tuple[list[dict[str, float]], np.ndarray]:
    """Learned weights from fold 0, from fold 1 and from both; and documents by fold and label."""
    sizes = np.zeros((2, 2))
    for r in rows.groupBy("fold", (F.col("toxic") > 0).cast("int").alias("y")).count().collect():
        sizes[r["fold"], r["y"]] = r["count"]
    total = ["clean0", "toxic0", "clean1", "toxic1"]
    counts = (
        rows.mapInArrow(_key_counts, "key string, " + ", ".join(f"{c} long" for c in total))
        .groupBy("key")
        .agg(*[F.sum(c).alias(c) for c in total])
    )
    weight = lambda t, c, nt, nc: F.log((t + 0.5) / (nt + 1)) - F.log((c + 0.5) / (nc + 1))
    sides = [
        (F.col("toxic0"), F.col("clean0"), *sizes[0, ::-1]),
        (F.col("toxic1"), F.col("clean1"), *sizes[1, ::-1]),
        (F.col("toxic0") + F.col("toxic1"), F.col("clean0") + F.col("clean1"), *sizes.sum(0)[::-1]),
    ]
    counts = stored(counts.filter(sides[2][0] >= SUPPORT), "keys")
    out = []
    for t, c, nt, nc in sides:
        w = weight(t, c, float(nt), float(nc))
        chosen = counts.filter((t >= SUPPORT) & (w >= RATIO)).select("key", w.alias("w"), t.alias("t"))
        best = chosen.orderBy(F.desc(F.col("w") * F.col("t")), "key").limit(ENTRIES)
        out.append({r.key: r.w for r in best.collect()})
    return out, sizes


def _feature_rows(learned: list[dict[str, float]]):
    def run(batches):
        weights = [_Weights(k) for k in learned]
        for batch in batches:
            names = batch.schema.names
            for part, texts in _texts(batch):
                fold = part.column(names.index("fold")).to_pylist()
                rows = [features_of(t, t.decode(), weights[f]) for t, f in zip(texts, fold)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(names.index("toxic")), part.column(names.index("fold")), pa.array(rows, pa.list_(pa.float64()))],
                    names=["toxic", "fold", "x"],
                )

    return run


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """Lexicon, trees and calibration from the labelled sample."""
    rows = training_rows(docs, labels, most)
    learned, sizes = lexicons(rows)
    if not sizes.sum(0).all():
        rate = float(sizes[:, 1].sum() / max(1.0, sizes.sum()))
        return Model({}, None, np.zeros(1), np.array([rate]))
    # each fold's features come from the lexicon of the other
    made = rows.mapInArrow(_feature_rows([learned[1], learned[0]]), "toxic int, fold int, x array<double>").toPandas()
    x, fold = np.array(made["x"].tolist(), dtype=float), made["fold"].to_numpy()
    y = (made["toxic"].to_numpy() > 0).astype(float)
    order = np.lexsort((*x.T, y, fold))  # the same trees whatever order the rows came in
    x, y, fold = x[order], y[order], fold[order]
    raw = np.zeros(len(y))
    for f in (0, 1):
        own, other = fold == f, fold != f
        raw[own] = Trees().fit(x[other], y[other]).raw(x[own]) if other.any() else 0.0
    knots, levels = isotonic(raw, y)
    return Model(learned[2], Trees().fit(x, y), knots, levels)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``score``."""
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights = _Weights(shared.value.learned)
        for batch in batches:
            for part, texts in _texts(batch):
                x = np.array([features_of(t, t.decode(), weights) for t in texts], dtype=float).reshape(-1, len(NAMES))
                arrays = [part.column(k) for k in range(part.num_columns)] + [pa.array(shared.value.score(x), pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def report(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """Per document: whether it was held out, its score and the prediction."""
    found = score(docs.select("doc_id", "text"), train(docs, labels, most))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns (``score`` dropped)."""
    return score(docs, train(docs, labels, most)).filter(F.col("score") < CUT).drop("score")
