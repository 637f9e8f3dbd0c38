"""Benchmark decontamination: windows of test items searched in whole documents.

A window is ``n`` consecutive words of an item, or all words of an item of fewer (none for an item
without words). The windows' hashes go to every task as one sorted array; hits are compared word by
word. Sets beyond ``BLOCK`` windows are searched block by block, so that no broadcast is larger.

Null or empty texts have no words and no hits. Repeated documents are searched each on its own, repeated
items count once by id, null item ids never count as items but their windows hit. An empty benchmark
hits nothing. Other columns are kept; columns named
like the search's own (``_item_words``, ``_item_hits``, ``_item_ids``) are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.binding import once
from textmill.llm import words
from textmill.session import stored

N = 10
#: Windows in one broadcast: about 60 MB with their words.
BLOCK = 250_000
CHUNK = 4 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SEPARATORS = bytes(i for i in range(128) if not words.ALPHANUMERIC[i])
_PLAIN = bytes.maketrans(UPPER.encode() + _SEPARATORS, LOWER.encode() + b" " * len(_SEPARATORS))


def item_words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, n: int = N) -> DataFrame:
    """``(window, length, items)``: each distinct window once, words joined by one space."""
    listed = items.select(F.col("item_id").cast("string").alias("item"), item_words(F.col("text")).alias("w"))
    places = lambda w: F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0)))
    cut = once(F.col("w"), lambda w: F.transform(places(w), lambda i: F.array_join(F.slice(w, i + 1, n), " ")))
    return (
        listed.filter(F.size("w") > 0)
        .select("item", F.least(F.size("w"), F.lit(n)).alias("length"), F.explode(cut).alias("window"))
        .groupBy("window", "length")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


class _Windows:
    """One block of windows as a task uses it."""

    def __init__(self, rows: list[tuple[str, int, list[str]]]):
        texts = [r[0].encode() for r in rows]
        h, bounds = words.hash_words(texts, words.ALPHANUMERIC)
        self.by_length: dict[int, tuple[np.ndarray, dict]] = {}
        keyed: dict[int, dict[int, list]] = {}
        for k, (_, length, items) in enumerate(rows):
            key = int(words.windows(h[bounds[k] : bounds[k + 1]], length)[0])
            keyed.setdefault(length, {}).setdefault(key, []).append((texts[k], items))
        for length, found in keyed.items():
            keys = np.array(sorted(found), dtype=np.uint64)
            self.by_length[length] = (keys, _filter(keys), found)

    def hits(self, texts: list[bytes]) -> tuple[np.ndarray, dict[int, list]]:
        """Words of each text, and of texts with hits ``(start, length, items)`` of each hit."""
        h, bounds = words.hash_words(texts, words.ALPHANUMERIC)
        found: dict[int, list] = {}
        split: dict[int, list[bytes]] = {}
        for length, (keys, near, listed) in self.by_length.items():
            w = words.windows(h, length)
            at = np.flatnonzero(near[(w >> np.uint64(44)).astype(np.int64)])
            if not len(at):
                continue
            place = np.minimum(np.searchsorted(keys, w[at]), len(keys) - 1)
            at = at[keys[place] == w[at]]
            doc = np.searchsorted(bounds, at, side="right") - 1
            inside = at + length <= bounds[doc + 1]
            for p, d in zip(at[inside].tolist(), doc[inside].tolist()):
                if d not in split:
                    split[d] = texts[d].translate(_PLAIN).split()
                start = p - int(bounds[d])
                exact = b" ".join(split[d][start : start + length])
                for window, items in listed[int(w[p])]:
                    if window == exact:
                        found.setdefault(d, []).append((start, length, items))
        return np.diff(bounds), found


def _filter(keys: np.ndarray) -> np.ndarray:
    """Which of the 2**20 high parts of a hash occur."""
    near = np.zeros(1 << 20, dtype=bool)
    near[(keys >> np.uint64(44)).astype(np.int64)] = True
    return near


def _marked(hits: list) -> list[tuple[int, int]]:
    """Hit words as disjoint ranges."""
    out: list[list[int]] = []
    for start, length, _ in sorted(hits, key=lambda x: (x[0], x[1])):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], start + length)
        else:
            out.append([start, start + length])
    return [(a, b) for a, b in out]


_HITS = "array<struct<first:long,last:long>>"


def _scan(docs: DataFrame, rows: list, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    schema = T.StructType(
        [f for f in docs.schema.fields if f.name not in ("_item_words", "_item_hits", "_item_ids")]
        + T.StructType.fromDDL(f"_item_words long, _item_hits {_HITS}, _item_ids array<string>").fields
    )

    def run(batches):
        block = _Windows(shared.value)
        for batch in batches:
            names = batch.schema.names
            column = batch.column(names.index(text))
            sizes = words.byte_sizes(column)
            kept = [k for k, x in enumerate(names) if x not in ("_item_words", "_item_hits", "_item_ids")]
            for a, b in words.slices(sizes, CHUNK):
                part = batch.slice(a, b - a)
                texts = words.as_bytes(part.column(names.index(text)))
                count, found = block.hits(texts)
                earlier = ("_item_hits" in names) and (part.column(names.index("_item_hits")).to_pylist(), part.column(names.index("_item_ids")).to_pylist())
                spans, items = [], []
                for k in range(len(texts)):
                    hits = found.get(k, [])
                    ids = {i for _, _, more in hits for i in more}
                    if earlier:
                        hits = hits + [(s["first"], s["last"] - s["first"], ()) for s in earlier[0][k]]
                        ids |= set(earlier[1][k])
                    spans.append([{"first": s, "last": e} for s, e in _marked(hits)])
                    items.append(sorted(ids))
                arrays = [part.column(k) for k in kept] + [
                    pa.array(count, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                    pa.array(items, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[names[k] for k in kept] + ["_item_words", "_item_hits", "_item_ids"])

    return docs.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, text: str = "text", n: int = N, block: int = BLOCK) -> DataFrame:
    """The documents with ``_item_words`` (number of words), ``_item_hits`` (hit words as ranges), ``_item_ids``."""
    windows = stored(item_windows(items, n), "windows")
    docs = docs.drop("_item_words", "_item_hits", "_item_ids")
    blocks = max(1, -(-windows.count() // block))
    for k in range(blocks):
        rows = windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).select("window", "length", "items")
        docs = _scan(docs, [tuple(r) for r in rows.collect()], text)
        if k + 1 < blocks:
            docs = stored(docs, "searched")
    return docs


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per document: words, hit words, items with hits and their digest, and the verdict."""
    found = search(docs.select("doc_id", "text"), items, **options)
    hit = F.aggregate("_item_hits", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id",
        F.col("_item_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("_item_ids", ","), 256).alias("items_sha256"),
        (F.size("_item_hits") > 0).alias("contaminated"),
    )


def _without(text: str, first_last: list) -> str:
    """The text without the words of the ranges (and what stands between them)."""
    import re

    places = [m.span() for m in re.finditer(WORD, text.translate(str.maketrans(UPPER, LOWER)))]
    out, at = [], 0
    for s in first_last:
        out.append(text[at : places[s["first"]][0]])
        at = places[s["last"] - 1][1]
    return "".join(out) + text[at:]


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "documents", **options) -> DataFrame:
    """The documents without contaminated ones, or (``remove="spans"``) without their hit words."""
    found = search(docs, items, **options)
    kept = [c for c in docs.columns if not c.startswith("_item_")]
    if remove == "documents":
        return found.filter(F.size("_item_hits") == 0).select(kept)
    cut = F.udf(_without, "string")
    clean = F.when(F.size("_item_hits") > 0, cut("text", "_item_hits")).otherwise(F.col("text"))
    return found.withColumn("text", clean).select(kept)


def digest(items: list[str]) -> str:
    """What ``items_sha256`` holds for a list of item ids."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least({N}, len(w)) AS n, unnest(range(1, greatest(len(w) - {N}, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, win)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
