"""Rows that carry texts or tokens are moved once, in groups of bounded size, and never turned into one row per token."""

from pyspark.sql import functions as F

from textmill.functions import cleaning, folding
from textmill.operators import examples, layout, ordering


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_buckets_follow_tokens_not_only_rows(spark):
    rows = [(i, "train" if i % 3 else None, 900 if i >= 90 else 1) for i in range(100)] + [(None, "val", 5), (7, "val", None)]
    docs = spark.createDataFrame(rows, "doc_id long, split string, size int")
    bounds = ordering.range_bounds(docs, "doc_id", 1000, F.coalesce("size", F.lit(0)) + 1)
    assert [b for b in bounds if b > 90] == list(range(91, 100))
    plain = layout.offsets(docs).collect()
    assert sorted(map(repr, layout.offsets(docs, tokens_per_bucket=1000).collect())) == sorted(map(repr, plain))


def test_running_totals_join_nothing(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("x").alias("split"), F.lit(2).alias("size"))
    placed = ordering.running_totals(
        docs.withColumn("b", (F.col("doc_id") / 10).cast("int")), {"start": F.col("size").cast("long")}, ["doc_id"], "b", ["split"]
    )
    assert "Join" not in _plan(placed)
    assert all(r.start == 2 * r.doc_id for r in placed.collect())


def test_blocks_are_cut_before_they_are_rows(spark):
    rows = [("train", 0, list(range(300))), ("train", 300, [1]), (None, 0, list(range(5)))]
    frame = spark.createDataFrame(rows, "split string, start long, tokens array<int>")
    blocks = examples.token_blocks(frame, length=64)
    assert "explode(sequence(" not in _plan(blocks)
    found = {(r.split, r.block): r.tokens for r in blocks.collect()}
    stream = [*range(300), 1]
    assert found == {
        **{("train", b): stream[64 * b : 64 * b + 65] for b in range(5)},
        (None, 0): list(range(5)),
    }


def test_marked_replacements_look_up_only_what_occurs(spark):
    pairs = [(chr(0x4E00 + i), f"<{i}>") for i in range(500)] + [("a丁", "never"), ("éè", ""), ("è", "e")]
    texts = ["plain", "", None, "一a丁乤 éè èè", "俿"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    done = frame.select("text", cleaning.replace_where_marked(F.col("text"), pairs).alias("out"))
    assert "array_contains" not in _plan(done)

    def one_by_one(text):
        for old, new in pairs:
            text = text.replace(old, new)
        return text

    assert all(r.out == (None if r.text is None else one_by_one(r.text)) for r in done.collect())


def test_hangul_leaves_other_text_in_one_part(spark):
    frame = spark.createDataFrame([("a\n" * 50 + "한글 값 é\U0001f642",), ("x",), (None,)], "text string")
    done = frame.select(folding.spell_hangul(F.col("text")).alias("out"))
    assert "split(" not in _plan(done)
    assert [r.out for r in done.collect()] == ["a\n" * 50 + done.first().out[100:], "x", None]
    assert done.first().out.endswith(" é\U0001f642") and "한" not in done.first().out
