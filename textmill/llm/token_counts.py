"""Token counts of documents under a byte-level pair-merge vocabulary, without token ids.

Texts are cut into pre-tokens. The first pass counts every distinct pre-token of the corpus once, and the
library counts the tokens of each. The second pass has per-document frequencies: the most frequent
pre-tokens (at most ``COMMON``, by a frequency threshold) are looked up in a broadcast of that bound; all others
are joined by a shuffle, in which no key is frequent. Sums follow; no id is ever kept.

Null and empty texts have 0 bytes and 0 tokens. Every row is counted on its own, repeated ids
too. Special tokens of the file count as one token each where their text occurs. An empty table
gives an empty result. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import words
from textmill.session import stored

COMMON = 200_000
LIMIT = 512
CHUNK = 4 << 20
HELD = 400_000  # distinct pre-tokens that a task counts before it passes them on

# The pre-token pattern of byte-level vocabularies, written out for characters up to U+017F,
# and those characters' letters, numbers and white space.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_PATTERN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BEYOND = re.compile("[^\x00-ſ]")


class _Cutter:
    """Pre-tokens of texts as the library cuts them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        pre = described["pre_tokenizer"] or {}
        if described["model"]["type"] != "BPE" or described.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("only byte-level pair-merge vocabularies without normalizer and prefix space are counted by pre-tokens")
        added = described.get("added_tokens") or []
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens with conditions are not counted by pre-tokens")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def cut(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text and its number of special tokens."""
        if self.special is None or self.special.search(text) is None:
            return self._plain(text), 0
        out: list[str] = []
        parts = self.special.split(text)
        for part in parts:
            out += self._plain(part)
        return out, len(parts) - 1

    def _plain(self, text: str) -> list[str]:
        if _BEYOND.search(text) is None:
            return _PATTERN.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def tokens(self, pieces: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch(pieces, add_special_tokens=False)]


@lru_cache(maxsize=4)
def cutter(path: str) -> _Cutter:
    return _Cutter(path)


def _texts(batch: pa.RecordBatch):
    column = batch.column(batch.schema.names.index("text"))
    for a, b in words.slices(words.byte_sizes(column), CHUNK):
        part = batch.slice(a, b - a)
        yield part, [t or "" for t in part.column(batch.schema.names.index("text")).to_pylist()]


def piece_counts(docs: DataFrame, path: str) -> DataFrame:
    """``(piece, n)``: distinct pre-tokens of the corpus with their frequency."""

    def run(batches):
        cut, held = cutter(path).cut, Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["piece", "n"])

        for batch in batches:
            for _, texts in _texts(batch):
                for text in texts:
                    held.update(cut(text)[0])
                if len(held) > HELD:
                    yield rows()
                    held.clear()
        yield rows()

    return docs.select("text").mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def piece_tokens(counts: DataFrame, path: str) -> DataFrame:
    """``(piece, n, tokens)``: the library counts each distinct pre-token once."""

    def run(batches):
        count = cutter(path).tokens
        for batch in batches:
            pieces = batch.column(0).to_pylist()
            found = [k for a in range(0, len(pieces), 2_000) for k in count(pieces[a : a + 2_000])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], names=["piece", "n", "tokens"])

    return counts.select("piece", "n").mapInArrow(run, "piece string, n long, tokens int")


def common_pieces(table: DataFrame, most: int = COMMON) -> tuple[int, dict[str, int]]:
    """Least frequency of a common pre-token, and the tokens of the at most ``most`` common ones."""
    step = F.floor(F.log2(F.col("n")) * 4).cast("int")
    sizes = sorted(table.groupBy(step.alias("step")).count().collect(), key=lambda r: -r.step)
    total, least = 0, None
    for r in sizes:
        total += r["count"]
        if total > most:
            break
        least = r.step
    if least is None:
        return 1 << 62, {}
    chosen = table.filter(step >= least).select("piece", "tokens", "n").toArrow()
    return min(chosen["n"].to_pylist()), dict(zip(chosen["piece"].to_pylist(), chosen["tokens"].to_pylist()))


def frequencies(docs: DataFrame, path: str, common: dict[str, int]) -> DataFrame:
    """``(doc_id, n_bytes, known, rare)``: tokens of common pre-tokens, and the others' frequencies."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        cut, look = cutter(path).cut, shared.value.get
        for batch in batches:
            names = batch.schema.names
            for part, texts in _texts(batch):
                known, pieces, many, ends = [], [], [], [0]
                for text in texts:
                    found, total = cut(text)
                    for piece, n in Counter(found).items():
                        tokens = look(piece)
                        if tokens is None:
                            pieces.append(piece)
                            many.append(n)
                        else:
                            total += n * tokens
                    known.append(total)
                    ends.append(len(pieces))
                offsets = pa.array(ends, pa.int32())
                column = part.column(names.index("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(names.index("doc_id")),
                        pa.array(words.byte_sizes(column), pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(pieces, pa.string())),
                        pa.ListArray.from_arrays(offsets, pa.array(many, pa.int64())),
                    ],
                    names=["doc_id", "n_bytes", "known", "pieces", "many"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, known long, pieces array<string>, many array<long>")


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, most: int = COMMON) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every document."""
    table = stored(piece_tokens(piece_counts(docs, path), path), "pieces")
    least, common = common_pieces(table, most)
    own = stored(frequencies(docs, path, common).withColumn("row", F.monotonically_increasing_id()), "frequencies")
    rare = own.select("row", F.explode(F.arrays_zip("pieces", "many")).alias("x")).select("row", "x.pieces", "x.many")
    rest = table.filter(F.col("n") < least).select("piece", "tokens")
    sums = (
        rare.join(rest, rare["pieces"] == rest["piece"])
        .groupBy("row")
        .agg(F.sum(F.col("many") * F.col("tokens")).alias("more"))
    )
    total = F.col("known") + F.coalesce("more", F.lit(0))
    counted = own.select("row", "doc_id", "n_bytes", "known").join(sums, "row", "left")
    return counted.select("doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))
