"""Quality rules: countable rules, then a log-likelihood ratio of hashed word n-grams.

Words and pairs of neighbouring words are hashed to buckets. Two multinomials over the buckets are estimated, one from
trusted documents and one from all documents, each smoothed by ``ALPHA`` counts a bucket. A document's score is the sum
of its n-grams' log ratios over their number. It is kept if no rule rejects it and its score reaches the threshold, one
for all documents.

The raw multinomial counts every document, without a join. The trusted one is fitted on four fifths of all trusted documents;
the other fifth sets the threshold: ``MARGIN`` times as far below their median score as the score that a share ``LOWEST`` of
them is under. The number of buckets follows the text's size, by the square root with which vocabularies grow, up to
``MOST_BUCKETS``, whose ratios are small enough to be broadcast; n-grams beyond share buckets.

Null and empty texts have no words and fail the rules; their score is 0. Repeated documents are
counted and judged each on its own. Without trusted documents every ratio is 0 and the rules alone decide. Null ids
are never trusted. Other columns are kept; those named like a result are replaced. Column expressions
and joins only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.binding import once
from textmill.session import stored

WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 5
LEAST_BUCKETS, MOST_BUCKETS = 1 << 14, 1 << 20
PER_ROOT = 16  # buckets for each root of an n-gram
ALPHA = 1.0
FIFTH = 5  # one in so many trusted documents is held out for the threshold
LOWEST, MARGIN = 0.005, 2.0
BITS = 1 << 24  # of the filter of trusted ids
BITMAP = 1 << 15  # bits of one of Spark's bitmaps
SALTS = 8
SLICE = 1 << 10
#: Largest share of words in repeated windows, in hundredths, and fewest words.
REPEATED, FEWEST = 20, 10


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def repeated_words(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more, from the windows' hashes in order."""

    def covered(places: Column) -> Column:
        begin = F.struct((places[0] - WINDOW).alias("at"), F.lit(0).alias("n"))
        step = lambda s, p: F.struct(p.alias("at"), (s["n"] + F.least(p - s["at"], F.lit(WINDOW))).alias("n"))
        return F.aggregate(places, begin, step, lambda s: s["n"])

    def places(ordered: Column) -> Column:
        same = lambda x, k: (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"])
        found = F.filter(ordered, lambda x, k: F.coalesce(same(x, k), F.lit(False)))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    ordered = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    count = once(once(ordered, places), covered)
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), count).otherwise(0)


def measured(docs: DataFrame) -> DataFrame:
    """The documents with ``_w`` (their words) and the counts that the rules use."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # bound once: a filter on a result may be pushed below, and must not cut the text anew for each window
    windows = once(
        F.col("_w"),
        lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW))),
    )
    none = F.array().cast("array<bigint>")
    split = docs.withColumns(
        {
            "_w": words_of(F.col("text")),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": once(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        }
    )
    hashed = split.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "word_chars": F.length(F.array_join("_w", "")).cast("long"),
            "_h": F.when(F.size("_w") >= WINDOW, windows).otherwise(none),
        }
    )
    repeats = once(F.col("_h"), repeated_words).cast("long")
    rejected = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    return hashed.withColumn("n_repeat_words", repeats).withColumn("base_failed", rejected).drop("_h")


def _pairs(words: str | Column) -> Column:
    """Each word with the next; the last one with null."""
    w = F.col(words) if isinstance(words, str) else words
    return F.arrays_zip(w.alias("a"), F.slice(w, F.lit(2), F.size(w)).alias("b"))


def _buckets(pair: Column, buckets: int) -> tuple[Column, Column]:
    """Buckets of the word and of the pair; null where there is no second word."""
    place = lambda *c: F.pmod(F.xxhash64(*c), F.lit(buckets)).cast("int")
    return place(pair["a"]), F.when(pair["b"].isNotNull(), place(pair["a"], pair["b"]))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all trusted documents."""
    return labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def trusted_documents(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of the documents with a trusted id.

    Bitmaps of the ids' hashes, ``BITS`` in all, drop nearly all others before the join, so that little
    more than the trusted texts is shuffled. One way of joining at every size; rows of one id are dealt by their text too.
    """
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(3)), F.lit(BITS))
    bit = F.pmod(place, F.lit(BITMAP))
    bitmaps = trusted.groupBy(F.floor(place / BITMAP).alias("_map")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), bit % 8)), F.lit(2)) == 1
    # at most BITS / BITMAP bitmaps
    near = (
        docs.select("doc_id", "text")
        .filter(F.col("doc_id").isNotNull())
        .join(F.broadcast(bitmaps), F.floor(place / BITMAP) == F.col("_map"))
        .filter(hit)
        .select("doc_id", "text", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int").alias("_salt"))
    )
    ids = trusted.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    return near.join(ids.hint("merge"), ["doc_id", "_salt"]).select("doc_id", "text")


def bucket_count(docs: DataFrame) -> int:
    """A power of two that grows with the root of the text's size; a word is taken to have six bytes."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = PER_ROOT * math.sqrt(size / 3)
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << round(math.log2(max(wanted, 1)))))


def _grams(docs: DataFrame, buckets: int, *keep: str) -> DataFrame:
    """Buckets of each word and, unless it is the last, of it and the next; one row of nulls for no words."""
    words = docs.select(*keep, F.explode_outer(_pairs("_w")).alias("p"))
    one, two = _buckets(F.col("p"), buckets)
    return words.select(*keep, F.when(F.col("p").isNotNull(), one).alias("one"), two.alias("two"))


def _counted(docs: DataFrame, buckets: int, name: str) -> DataFrame:
    grams = _grams(docs.select(words_of(F.col("text")).alias("_w")), buckets)
    each = grams.select(F.explode(F.array("one", "two")).alias("bucket")).filter(F.col("bucket").isNotNull())
    return each.groupBy("bucket").agg(F.count("*").alias(name))


def fitted(docs: DataFrame, chosen: DataFrame, buckets: int, alpha: float = ALPHA) -> DataFrame:
    """``(bucket, ratio)``: log of the share in ``chosen`` over the share in all documents."""
    raw, good = _counted(docs, buckets, "raw"), _counted(chosen, buckets, "good")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    count = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    filled = stored(every.join(raw, "bucket", "left").join(good, "bucket", "left").select("bucket", count("raw"), count("good")), "buckets")
    total = filled.agg(F.sum("raw").alias("f"), F.sum("good").alias("g"))
    share = lambda n, of: (F.col(n) + F.lit(alpha)) / (F.col(of) + F.lit(alpha * buckets))
    ratio = F.when(F.col("g") > 0, F.log(share("good", "g") / share("raw", "f"))).otherwise(0.0)
    return stored(filled.join(F.broadcast(total)).select("bucket", ratio.alias("ratio")), "ratios")


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = LEAST_BUCKETS, alpha: float = ALPHA) -> DataFrame:
    """One row with ``ratios``, by bucket, fitted on all documents of the trusted ids."""
    table = fitted(docs, trusted_documents(docs, trusted), buckets, alpha)
    # slices of a fixed number of buckets first
    slices = table.groupBy(F.floor(F.col("bucket") / SLICE).alias("slice")).agg(F.sort_array(F.collect_list(F.struct("bucket", "ratio")))["ratio"].alias("part"))
    return slices.agg(F.flatten(F.sort_array(F.collect_list(F.struct("slice", "part")))["part"]).alias("ratios"))


RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def scored(docs: DataFrame, ratios: DataFrame, buckets: int, *keep: str) -> DataFrame:
    """``keep``, the rules' counts and ``score`` of each document with ``text``.

    The rows of a document's words are summed where they are; only one row for each document is shuffled.
    """
    held = measured(docs.select(*keep, F.monotonically_increasing_id().alias("_row"), "text")).drop("text")
    one = F.broadcast(ratios.select(F.col("bucket").alias("one"), F.col("ratio").alias("_r1")))
    two = F.broadcast(ratios.select(F.col("bucket").alias("two"), F.col("ratio").alias("_r2")))
    names = ["_row", *keep, *RULES]
    found = _grams(held, buckets, *names).join(one, "one", "left").join(two, "two", "left")
    total = F.sum(F.coalesce("_r1", F.lit(0.0)) + F.coalesce("_r2", F.lit(0.0)))
    mean = F.when(F.col("n_words") > 0, F.col("_total") / (2 * F.col("n_words") - 1)).otherwise(0.0)
    return found.groupBy(*names).agg(total.alias("_total")).select(*keep, "_row", *RULES, F.round(mean, 9).alias("score"))


def _model(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int, float]:
    """Ratios, their number and the threshold."""
    buckets = bucket_count(docs)
    chosen = stored(trusted_documents(docs, trusted_ids(labels)), "trusted")
    aside = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.lit(FIFTH)) == 0
    ratios = fitted(docs, chosen.filter(~aside), buckets)
    sound = scored(chosen.filter(aside), ratios, buckets).filter("NOT base_failed")
    low, middle = sound.agg(F.percentile_approx("score", [LOWEST, 0.5], 10_000)).first()[0] or (-math.inf, 0.0)
    return ratios, buckets, middle - MARGIN * (middle - low)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: the counts, the rules' verdict, the score and whether it is kept."""
    ratios, buckets, threshold = _model(docs, labels)
    judged = scored(docs.select("doc_id", "text"), ratios, buckets, "doc_id")
    return judged.select("doc_id", *RULES, (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"), "score")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that rules and score keep; their rows are written once, to be found again."""
    held = stored(docs.withColumn("_place", F.monotonically_increasing_id()), "documents")
    ratios, buckets, threshold = _model(held, labels)
    judged = scored(held.select("_place", "text"), ratios, buckets, "_place")
    good = judged.filter(~F.col("base_failed") & (F.col("score") >= threshold)).select("_place")
    return held.join(good, "_place").select(docs.columns)
