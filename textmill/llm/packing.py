"""Packing: non-negative least squares on the histogram of piece lengths, residuals packed greedily.

A document's token ids, ended by id 0, are cut into whole windows and a rest shorter than a window. Rests are packed by a
plan made from their histogram, which has fewer bins than a window has tokens whatever the input's size: all combinations
of two or three lengths that fill a window exactly are enumerated, least squares give each a non-negative repeat
count, counts are rounded down, and what is left is packed greedily: large numbers of one length among themselves, then
longest piece first with the best fit; where nothing fits, a longer piece is cut to fill the window. So every sequence
is full but the last one of rests.

The plan says which ranks of each length go where; the rank of a row among the rests of its length comes from counts per
task and a running sum over tasks, so that a length that a third of all rows share is spread like any other. Token
ids of a rest are shuffled once, whole windows never.

A null or empty text is a document of the one id 0. Every row is packed on its own, repeated ids and rows too; null
ids are kept. Texts of any length are encoded in segments. Strings of added tokens in a text count as those tokens, the
library's default. Sequences hold at most ``window`` tokens and are to be padded to it unless their length is a power
of two. ``sequence_id`` is unique but not gapless: whole windows are numbered by task. An empty
table gives an empty result. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm import token_counts, words
from textmill.operators import ordering
from textmill.session import stored

WINDOW = 1024
DEPTH = 3
END = 0
CHUNK = 4 << 20  # bytes of text encoded before rows are passed on
SEGMENT = 1 << 20  # characters of a text encoded at once
HELD, LONGEST_HELD = 400_000, 64  # pre-tokens whose ids a task remembers, and their characters
ROUNDS = 150  # of the descent, at most
MANY = 8  # rows of one residual length that are packed among themselves
UNITS = 64  # parts in which the ranks of a length are looked up
TASKS_PER_STRETCH = 1_000
_GAP = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")


def _byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself if it is printable, else as the next free character from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(others)}}


class Encoder:
    """Little-endian 32-bit ids of texts, as the library gives them, by pre-tokens encoded once."""

    def __init__(self, path: str):
        self.cutter = token_counts.cutter(path)
        self.ids: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in described.get("added_tokens") or []}
        names = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.merger = self._merger(described["model"])

    def _merger(self, model: dict):
        """Merges by rank where a token's id is its merge's place; else the library's own."""
        byte, table = _byte_characters(), {}
        for token, i in model["vocab"].items():
            if token not in self.added:
                if any(c not in byte for c in token):
                    return None
                table[bytes(byte[c] for c in token)] = i
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if [model["vocab"].get(a + b) for a, b in pairs] != list(range(256, 256 + len(pairs))) or model.get("ignore_merges"):
            return None
        import tiktoken

        return tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=table, special_tokens={})

    def _learn(self, new: set[str]) -> None:
        if self.merger is not None:
            encode = self.merger.encode_ordinary
            self.ids.update([(p, _bytes(encode(p))) for p in new])
        else:
            names = list(new)
            self.ids.update((p, _bytes(e.ids)) for p, e in zip(names, self.cutter.library.encode_batch(names, add_special_tokens=False)))

    def _plain(self, text: str) -> bytes:
        pieces = self.cutter.cut(text)[0]
        held = self.ids
        if len(held) > HELD:
            held.clear()
        out = list(map(held.get, pieces))
        missing = [i for i, ids in enumerate(out) if ids is None]
        if missing:
            new = {pieces[i] for i in missing}
            self._learn(new)
            for i in missing:
                out[i] = held[pieces[i]]
            for p in new:
                if len(p) > LONGEST_HELD:
                    del held[p]
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        parts = self.special.split(text) if any(name in text for name in self.added) else [text]
        out = []
        for k, part in enumerate(parts):
            out += [self.added[part]] if k % 2 else [self._plain(s) for s in _segments(part)]
        return b"".join(out)


def _bytes(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


def _segments(text: str) -> Iterator[str]:
    """A long text cut where a word ends before a blank and a word: no pre-token crosses such a place."""
    at = 0
    while len(text) - at > SEGMENT:
        gap = _GAP.search(text, at + SEGMENT)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:] if at else text


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Whole windows and rests: ``(doc_id, doc_tokens, start, length, ids, task, place)``.

    ``place`` is the number of earlier rows of the task that are whole windows, or rests of the same length.
    """

    def run(batches):
        from pyspark import TaskContext

        task, encode = TaskContext.get().partitionId(), encoder(path).encode
        places, end = [0] * (window + 1), np.array([END], "<u4").tobytes()
        names = ["doc_id", "doc_tokens", "start", "length", "ids", "task", "place"]
        for batch in batches:
            column = batch.column(batch.schema.names.index("text"))
            for a, b in words.slices(words.byte_sizes(column), CHUNK):
                of, total, start, length, ids, place = [], [], [], [], [], []
                for row, text in enumerate(column.slice(a, b - a).to_pylist(), a):
                    data = encode(text or "") + end
                    for at in range(0, len(data), 4 * window):
                        part = data[at : at + 4 * window]
                        n = len(part) // 4
                        of.append(row)
                        total.append(len(data) // 4)
                        start.append(at // 4)
                        length.append(n)
                        ids.append(part)
                        place.append(places[n])
                        places[n] += 1
                long = lambda x: pa.array(x, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.names.index("doc_id")).take(pa.array(of, pa.int64())), long(total), long(start), long(length), pa.array(ids, pa.binary()), pa.array([task] * len(of), pa.int32()), long(place)],
                    names=names,
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, doc_tokens long, start long, length long, ids binary, task int, place long"
    )


def combinations(lengths: np.ndarray, window: int = WINDOW, depth: int = DEPTH) -> np.ndarray:
    """All two and, at depth 3, three of the lengths that fill a window, longest first; 0 stands for none."""
    present = np.zeros(window + 1, bool)
    present[lengths] = True
    a, b = np.meshgrid(lengths, np.append(lengths, 0) if depth > 2 else np.zeros(1, np.int64), indexing="ij")
    a, c = a.ravel(), b.ravel()
    b = window - a - c
    fits = (a >= b) & (b >= np.maximum(c, 1))
    a, b, c = a[fits], b[fits], c[fits]
    real = present[b]
    return np.stack([a[real], b[real], c[real]], axis=1)


def repeat_counts(histogram: np.ndarray, columns: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative least squares: repeats of each combination that come nearest to the histogram.

    Block coordinate descent: of the combinations whose best own change lowers the squared error most, those without a
    common length change together, none below zero, until no change reaches half a repeat. Pairs are
    fitted before combinations of three. Long pieces weigh more, since short ones are easily packed afterwards.
    """
    window = len(histogram) - 1
    weight = (np.arange(window + 1) / window) ** 2
    same = lambda i, k: 2.0 * (columns[:, i] == columns[:, k]) * weight[columns[:, i]]
    norm = weight[columns].sum(axis=1) + same(0, 1) + same(0, 2) + same(1, 2)
    x, left = np.zeros(len(columns)), histogram.astype(float)
    for allowed in (columns[:, 2] == 0, np.ones(len(columns), bool)):
        places = np.flatnonzero(allowed)
        for _ in range(rounds if len(places) else 0):
            slope = (weight * left)[columns[places]].sum(axis=1)
            change = np.maximum(slope / norm[places], -x[places])
            gain = change * (slope - 0.5 * norm[places] * change)
            gain[np.abs(change) < 0.5] = 0
            steep = np.argpartition(-gain, min(2 * window, len(gain) - 1))[: 2 * window]
            steep = steep[gain[steep] > 0]
            taken, moved = np.zeros(window + 1, bool), []
            for j in steep[np.argsort(-gain[steep], kind="stable")].tolist():
                own = columns[places[j]]
                own = own[own > 0]
                if not taken[own].any():
                    taken[own] = True
                    moved.append(j)
            if not moved:
                break
            x[places[moved]] += change[moved]
            for k in range(columns.shape[1]):
                np.subtract.at(left, columns[places[moved], k], change[moved])
            left[0] = 0
    return x


class Plan:
    """Which ranks of each length go where: rows ``(length, low, high, start, size, sequence, offset)``.

    Rests of ``length`` with rank ``low`` to ``high - 1`` have the piece ``start``, ``size``, at ``offset`` of the
    sequence ``sequence + rank - low``.
    """

    def __init__(self, histogram: dict[int, int], window: int = WINDOW, depth: int = DEPTH):
        self.window = window
        self.rows: list[tuple[int, int, int, int, int, int, int]] = []
        self.sequences = 0
        #: By size: parts of the ranks not yet placed, ``[length, low, count, start, size]``.
        self.left: dict[int, list[list[int]]] = {n: [[n, 0, c, 0, n]] for n, c in sorted(histogram.items()) if c > 0}
        if self.left:
            self._solve(depth)
            self._among_themselves()
            self._greedy()

    def _place(self, parts: list[tuple[list[int], int]], times: int) -> None:
        """``times`` windows of the given parts and sizes; a longer part is cut and its end kept."""
        offset = 0
        for part, size in parts:
            length, low, _, start, whole = part
            self.rows.append((length, low, low + times, start, size, self.sequences, offset))
            offset += size
            part[1] += times
            part[2] -= times
            if whole > size:
                self.left.setdefault(whole - size, []).append([length, low, times, start + size, whole - size])
        self.sequences += times

    def _solve(self, depth: int) -> None:
        lengths = np.array(sorted(self.left), np.int64)
        columns = combinations(lengths, self.window, depth)
        if not len(columns):
            return
        histogram = np.zeros(self.window + 1)
        for n, parts in self.left.items():
            histogram[n] = parts[0][2]
        counts = np.floor(repeat_counts(histogram, columns) + 1e-6).astype(np.int64)
        for j in np.argsort(-counts, kind="stable"):
            if counts[j] <= 0:
                break
            sizes = [int(n) for n in columns[j] if n]
            times = min([int(counts[j]), *[self.left[n][0][2] // sizes.count(n) for n in sizes]])
            if times:
                self._place([(self.left[n][0], n) for n in sizes], times)

    def _among_themselves(self) -> None:
        """Lengths that least squares leave in large numbers fill windows with pieces of their own kind.

        Each step leaves a shorter piece for every window at most, so counts fall by half at least.
        """
        for size in range(self.window - 1, 0, -1):
            for part in self.left.get(size, []):
                whole, room = divmod(self.window, size)
                times = part[2] // (whole + (room > 0))
                if part[2] >= MANY and times:
                    self._place([(part, size)] * whole + [(part, room)] * (room > 0), times)

    def _greedy(self) -> None:
        while True:
            self.left = {n: live for n, parts in self.left.items() if (live := [p for p in parts if p[2] > 0])}
            if not self.left:
                return
            room, chosen, uses = self.window, [], {}

            def free(size: int):
                """A part of that size that has rows left for one more use in the same windows."""
                for part in self.left[size]:
                    if part[2] > uses.get(id(part), 0):
                        return part
                return None

            order = sorted(self.left, reverse=True)
            while room:
                size = next((n for n in order if n <= room and free(n)), None)
                if size is None:  # nothing fits: the shortest that is longer is cut
                    size = next((n for n in reversed(order) if n > room and free(n)), None)
                if size is None:
                    break
                part = free(size)
                uses[id(part)] = uses.get(id(part), 0) + 1
                chosen.append((part, min(size, room)))
                room -= min(size, room)
            self._place(chosen, min(part[2] // uses[id(part)] for part, _ in chosen))


def pack(docs: DataFrame, path: str, window: int = WINDOW, depth: int = DEPTH) -> DataFrame:
    """Pieces with their ids and places: ``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``.

    ``ids`` are little-endian 32-bit numbers.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, path, window), "pieces")
    rests = cut.filter(F.col("length") < window)
    counts = stored(rests.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    # fewer lengths than a window has tokens
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(histogram, window, depth)
    units = {n: -(-c // UNITS) for n, c in histogram.items()}
    rows = [(*r, unit) for r in plan.rows for unit in range(r[1] // units[r[0]], (r[2] - 1) // units[r[0]] + 1)]
    places = spark.createDataFrame(rows, "_length long, low long, high long, from long, size long, sequence long, offset long, _unit long")

    starts = ordering.running_totals(
        counts.withColumn("_stretch", F.floor(F.col("task") / TASKS_PER_STRETCH)), {"before": F.col("n")}, order=["task"], bucket="_stretch", within=["length"]
    ).select(F.col("length").alias("_n"), F.col("task").alias("_task"), "before")
    unit = F.get(F.array(*[F.lit(units.get(n, 1)).cast("long") for n in range(window)]), F.col("length").cast("int"))
    ranked = rests.join(starts, (F.col("length") == F.col("_n")) & (F.col("task") == F.col("_task"))).withColumn("rank", F.col("before") + F.col("place"))
    # the plan has a bounded number of rows, whatever the input's size
    found = ranked.withColumn("_unit_of", F.floor(F.col("rank") / unit)).join(
        F.broadcast(places),
        (F.col("length") == F.col("_length")) & (F.col("_unit_of") == F.col("_unit")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    packed = found.select(
        "doc_id",
        (F.col("start") + F.col("from")).alias("start"),
        F.col("size").alias("length"),
        "doc_tokens",
        (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"),
        "offset",
        F.substring("ids", (F.col("from") * 4 + 1).cast("int"), (F.col("size") * 4).cast("int")).alias("ids"),
    )
    # numbered by task, beyond the plan's sequences
    own = F.lit(plan.sequences).cast("long") + F.shiftleft(F.col("task").cast("long"), 33) + F.col("place")
    whole = cut.filter(F.col("length") == window).select(
        "doc_id", "start", "length", "doc_tokens", own.alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids"
    )
    return packed.unionByName(whole)


def report(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Pieces with a checksum of their ids."""
    return pack(docs, path, window).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
