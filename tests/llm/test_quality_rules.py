import math
import re
import struct
from collections import Counter

import xxhash

from textmill.llm import quality_rules as Q

SMALL = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    w = re.findall(Q.WORD, text)
    lines = [x for x in text.split("\n") if re.search(Q.WORD, x)]
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    repeated = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    n = len(w)
    failed = n < 10 or 100 * len(repeated) > 20 * n
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed)


def counts(frame):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return sorted(((r.doc_id, *(r[x] for x in names)) for r in frame.collect()), key=repr)


def test_rules_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    report = Q.report(docs, labels)
    expected = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
    assert counts(report) == expected
    assert all(not r.kept for r in report.collect() if r.base_failed)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    kept = Counter((quality[r.doc_id], r.kept) for r in report.collect() if r.doc_id in quality and not r.base_failed)
    assert kept[1, True] > 0.97 * (kept[1, True] + kept[1, False])


ODD = [
    (1, None), (2, ""), (3, "a b c d e f g a b c d e f g h"), (3, "a a a a a a a a a a a a"), (4, "x\n\nx\n x\nx\t\n"),
    (None, "p " * 40), (5, "word " * 30_000), (6, " ".join(str(i) for i in range(40_000))), (7, "\x00 \x85   \U0001f600# <|>"),
    (8, "a b c d e . a b c d e . b c d e . z"), (8, "a b c d e . a b c d e . b c d e . z"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in ODD], "doc_id long, text string, score int").repartition(3)
    labels = spark.createDataFrame([(8, 1), (None, 1), (5, None)], "doc_id long, quality int")
    assert counts(Q.report(docs, labels)) == sorted(((i, *brute(t)) for i, t in ODD), key=repr)
    assert Q.report(docs.limit(0), labels).count() == 0
    assert {r.score for r in Q.report(docs, labels.limit(0)).collect()} == {0.0}


def test_ratio_by_hand(spark):
    docs = spark.createDataFrame([(1, "good good"), (2, "bad bad bad")], "doc_id long, text string")
    trusted = spark.createDataFrame([(1,)], "doc_id long")
    ratios = Q.log_ratios(docs, trusted, buckets=64).first().ratios
    place = {r.w: r.b for r in spark.sql("SELECT w, pmod(xxhash64(w), 64) AS b FROM VALUES ('good'), ('bad') AS t(w)").collect()}
    assert len(set(place.values())) == 2
    pair = spark.sql("SELECT pmod(xxhash64('good', 'good'), 64) AS g, pmod(xxhash64('bad', 'bad'), 64) AS b").first()
    good = Counter([place["good"]] * 2 + [pair.g])
    raw = good + Counter([place["bad"]] * 3 + [pair.b] * 2)
    for k in range(64):
        want = math.log(((good[k] + 1) / (3 + 64)) / ((raw[k] + 1) / (8 + 64)))
        assert abs(ratios[k] - want) < 1e-12


def test_all_trusted_documents_count(spark):
    labels = spark.range(60_000).selectExpr("id AS doc_id", "1 AS quality")
    docs = spark.range(60_000).selectExpr("id AS doc_id", "'one' AS text").union(spark.sql("SELECT CAST(NULL AS bigint), 'two'"))
    assert Q.trusted_ids(labels).count() == 60_000
    ratios = Q.log_ratios(docs, Q.trusted_ids(labels), buckets=64).first().ratios
    place = spark.sql("SELECT pmod(xxhash64('one'), 64) AS b").first().b
    assert abs(ratios[place] - math.log((60_001 / 60_064) / (60_001 / 60_065))) < 1e-12


def hashed(*parts):
    """The engine's 64-bit hash, signed."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64(struct.pack("<i", p) if isinstance(p, int) else p.encode(), seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def model_by_hand(rows, trusted, buckets):
    """Scores and verdicts of ``(doc_id, text)`` rows by plain loops."""
    grams = []
    for _, text in rows:
        w = re.findall(Q.WORD, text or "")
        grams.append([hashed(x) % buckets for x in w] + [hashed(*p) % buckets for p in zip(w, w[1:])])
    aside = [hashed(str(i), 7) % Q.FIFTH == 0 for i, _ in rows]
    good, raw = Counter(), Counter()
    for (i, _), g, a in zip(rows, grams, aside):
        raw.update(g)
        if i in trusted and not a:
            good.update(g)
    share = lambda c, k: (c[k] + Q.ALPHA) / (c.total() + Q.ALPHA * buckets)
    ratio = {k: math.log(share(good, k) / share(raw, k)) for k in raw}
    scores = [round(sum(ratio[k] for k in g) / len(g), 9) if g else 0.0 for g in grams]
    failed = [brute(text)[-1] for _, text in rows]
    held = sorted(s for (i, _), s, f, a in zip(rows, scores, failed, aside) if i in trusted and a and not f)
    pick = lambda share: held[max(math.ceil(share * len(held)), 1) - 1]
    threshold = pick(0.5) - Q.MARGIN * (pick(0.5) - pick(Q.LOWEST))
    return [(i, s, not f and s >= threshold) for (i, _), s, f in zip(rows, scores, failed)]


def test_scores_and_verdicts_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = {i: (s, k) for i, s, k in model_by_hand(rows, {i for i, q in quality.items() if q == 1}, Q.bucket_count(docs))}
    found = Q.report(docs, labels).collect()
    assert len(found) == len(rows)
    for r in found:
        score, kept = expected[r.doc_id]
        assert abs(r.score - score) < 1e-8 and r.kept == kept
    kept = Counter((quality[r.doc_id], r.kept) for r in found if r.doc_id in quality and not r.base_failed)
    assert kept[0, True] <= 0.15 * (kept[0, True] + kept[0, False])
    assert kept[1, True] >= 0.97 * (kept[1, True] + kept[1, False])


def test_keep_good_returns_the_rows(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(j, j + 12)), "x") for j, i in enumerate([1, 1, 2, None])] + [(3, "few words", "y")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert sorted(Q.keep_good(docs, none).collect(), key=repr) == sorted(docs.filter("score = 'x'").collect(), key=repr)
    some = Q.keep_good(docs, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int"))
    assert some.columns == docs.columns and {1, 2} <= {r.doc_id for r in some.collect()} <= {1, 2, None}


def test_filter_of_trusted_ids_loses_none(spark, monkeypatch):
    monkeypatch.setattr(Q, "BITS", 1 << 16)
    docs = spark.range(3_000).selectExpr("id AS doc_id", "concat('t', id % 7) AS text").union(spark.sql("SELECT 4L, 'again'"))
    ids = spark.range(0, 3_000, 4).toDF("doc_id")
    found = Q.trusted_documents(docs, ids).collect()
    assert sorted(r.doc_id for r in found) == sorted([*range(0, 3_000, 4), 4])
