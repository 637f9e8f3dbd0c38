import datetime

import pytest
from pyspark.sql import functions as F

from textmill.operators import chat, examples, layout, metrics

SIZES = [3, 64, 65, 1, 1, 200, 128, 64, 64, 7, 2, 0, 500]


def stored_tokens(spark, sizes, split="train"):
    rows, at = [], 0
    for i, size in enumerate(sizes):
        rows.append((i, split, list(range(at, at + size)), size))
        at += size
    held = spark.createDataFrame(rows, "doc_id long, split string, tokens array<int>, size int")
    return layout.offsets(held, rows_per_bucket=3), list(range(at))


@pytest.mark.parametrize("length", [1, 4, 64])
@pytest.mark.parametrize("sizes", [SIZES, [64], [65], [128], [1], [1, 1, 63]])
def test_blocks_equal_slices_of_the_stream(spark, sizes, length):
    placed, stream = stored_tokens(spark, sizes)
    got = {r.block: r.tokens for r in examples.token_blocks(placed, length).collect()}
    # the last token of a stream that ends on a block edge is the last target only
    want = {
        b: stream[b * length : b * length + length + 1]
        for b in range((len(stream) - 1) // length + 1)
    }
    assert got == want


def test_examples_shift_by_one_and_keep_every_token(spark):
    placed, stream = stored_tokens(spark, SIZES)
    rows = (
        examples.next_token_examples(examples.token_blocks(placed)).orderBy("block").collect()
    )
    assert [t for r in rows for t in r.x] == stream
    assert all(r.y == [t + 1 for t in r.x][: len(r.y)] for r in rows)


def test_padding_and_mask(spark):
    placed, stream = stored_tokens(spark, [70])
    rows = (
        examples.pad_examples(
            examples.next_token_examples(examples.token_blocks(placed)), padding_id=-1
        )
        .orderBy("block")
        .collect()
    )
    assert [len(r.x) for r in rows] == [len(r.y) for r in rows] == [64, 64]
    assert rows[1].x == [64, 65, 66, 67, 68, 69] + [-1] * 58
    assert rows[1].y == [65, 66, 67, 68, 69] + [-1] * 59
    assert rows[1].mask == [True] * 5 + [False] * 59


def test_batches_are_a_fresh_permutation_each_epoch(spark):
    data = spark.range(1_000).withColumnRenamed("id", "block")
    rows = examples.shuffled_batches(data, epochs=3, batch_size=64, seed=1).collect()
    orders = []
    for epoch in range(3):
        mine = sorted((r.batch, r.slot, r.block) for r in rows if r.epoch == epoch)
        assert [b * 64 + s for b, s, _ in mine] == list(range(1_000))
        orders.append([block for _, _, block in mine])
        assert sorted(orders[-1]) == list(range(1_000))
    assert orders[0] != orders[1] != orders[2] != sorted(orders[2])


TURNS = [
    (1, 0, "system", "s"),
    (1, 1, "user", "u\n"),
    (1, 2, "assistant", ""),
    (2, 5, "human", "h"),
    (2, 6, "robot", None),
]


def test_chat_rendering(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.text for r in chat.render_conversations(turns).collect()}
    assert got == {
        1: "<|startoftext|><|system|>s<|user|>u\n<|assistant|><|endoftext|>",
        2: "<|startoftext|><|human|>h<|unknown|><|endoftext|>",
    }


def test_long_conversation_comes_in_parts(spark):
    turns = spark.range(5_000).select(
        F.lit(1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.lit("user").alias("role"),
        F.col("id").cast("string").alias("text"),
    )
    parts = chat.render_conversations(turns, turns_per_part=1_000).orderBy("part").collect()
    assert [p.part for p in parts] == [0, 1, 2, 3, 4]
    whole = "<|startoftext|>" + "".join(f"<|user|>{i}" for i in range(5_000)) + "<|endoftext|>"
    assert "".join(p.text for p in parts) == whole


def records(spark, count):
    start = datetime.datetime(2024, 1, 1)
    rows = [
        (
            run,
            start + datetime.timedelta(seconds=i * (i + 1)),
            i,
            i // 10,
            float((i * 7919) % 101),
            float((i * 104729) % 97 + 1),
        )
        for run, length in (("a", count), ("b", 3))
        for i in range(length)
    ]
    return spark.createDataFrame(
        rows, "run string, ts timestamp, iter long, epochs long, loss double, val_loss double"
    ).repartition(5)


@pytest.mark.parametrize("per_bucket", [1, 7, 1_000])
def test_elapsed_and_running_best(spark, per_bucket):
    data = records(spark, 60)
    timed = metrics.with_elapsed(data, per_bucket=per_bucket).orderBy("run", "iter").collect()
    assert [r.elapsed for r in timed if r.run == "a"] == [None] + [2.0 * i for i in range(1, 60)]
    rows = metrics.with_running_best(data, per_bucket=per_bucket).orderBy("run", "iter").collect()
    losses = [float((i * 104729) % 97 + 1) for i in range(60)]
    assert [r.best_val_loss for r in rows if r.run == "a"] == [
        min(losses[: i + 1]) for i in range(60)
    ]


def test_append_and_resume(spark, tmp_path):
    path = str(tmp_path / "metrics")
    data = records(spark, 60)
    metrics.append_metrics(data.filter("iter < 30"), path)
    metrics.append_metrics(data.filter("iter >= 30"), path)
    held = spark.read.parquet(path)
    assert held.count() == 63
    row = metrics.latest_metrics(held).filter("run = 'a'").first()
    assert (row.iter, row.epochs, row.loss) == (59, 5, float((59 * 7919) % 101))
    assert row.best_val_loss == min(float((i * 104729) % 97 + 1) for i in range(60))
    losses = metrics.epoch_losses(held).filter("run = 'a' AND epochs = 2").first()
    assert losses.batches == 10
    assert losses.epoch_loss == pytest.approx(sum((i * 7919) % 101 for i in range(20, 30)) / 10)
    assert {(r.run, r.iter) for r in metrics.validation_rows(held).collect()} == {
        ("a", 0),
        ("a", 50),
        ("b", 0),
    }
