import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill import session
from textmill.operators import layout
from textmill.plans import prepare
from textmill.sources import corpus, text_array, token_store
from textmill.streaming import documents as streaming

SMALL = "/root/testdata/sf0.001"


def test_corpus_schema_and_pruning(spark):
    docs = corpus.read_corpus(spark, f"{SMALL}/documents.parquet", source="wikipedia")
    assert docs.columns == ["doc_id", "source", "text"]
    plan = docs.select("doc_id").filter("doc_id = 3")._jdf.queryExecution().executedPlan()
    assert "ReadSchema: struct<doc_id:bigint>" in plan.toString()
    assert "EqualTo(doc_id,3)" in plan.toString()


def test_corpus_formats(spark, tmp_path):
    rows = [(1, "a"), (2, "b\nc")]
    frame = spark.createDataFrame(rows, "n long, body string")
    for fmt in ("parquet", "json", "orc"):
        path = str(tmp_path / fmt)
        frame.write.format(fmt).save(path)
        docs = corpus.read_corpus(
            spark, path, "s", fmt, text_col="body", id_col="n", schema="n long, body string"
        )
        assert sorted(map(tuple, docs.collect())) == [(1, "s", "a"), (2, "s", "b\nc")]
    with pytest.raises(ValueError):
        corpus.read_corpus(spark, path, fmt="orc")
    with pytest.raises(ValueError):
        corpus.read_corpus(spark, path, fmt="csv")
    (tmp_path / "lines.txt").write_text("one\ntwo\n")
    lines = corpus.read_corpus(spark, str(tmp_path / "lines.txt"), "t", "text")
    assert [r.text for r in lines.orderBy("doc_id").collect()] == ["one", "two"]


def save(spark, values, path, partitions=5):
    rows = list(enumerate(values))
    array = spark.createDataFrame(rows, "pos long, value string").repartition(partitions)
    text_array.save_text_array(array, path)
    found = text_array.load_text_array(spark, path).orderBy("pos").collect()
    assert [r.pos for r in found] == list(range(len(found)))
    return [r.value for r in found]


def test_text_array_round_trip(spark, tmp_path):
    path = str(tmp_path / "lines")
    values = ["a", "", "b\rc", " é ", ""] + [str(i) for i in range(300)]
    assert save(spark, values, path) == values
    assert save(spark, ["a\nb"], path) == ["a", "b"]


def test_text_array_in_many_splits(spark, tmp_path):
    values = [f"line {i}" * (i % 7) for i in range(2_000)]
    path = str(tmp_path / "lines")
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "2000")
        assert save(spark, values, path) == values
    finally:
        spark.conf.set(size, before)


@pytest.mark.parametrize(
    "content, want",
    [("a\n\nb", ["a", "", "b"]), ("", [""]), ("a\nb\n", ["a", "b", ""]), ("\r\n", ["\r", ""])],
)
def test_text_file_is_exact(spark, tmp_path, content, want):
    path = tmp_path / "file.txt"
    path.write_bytes(content.encode())
    rows = text_array.load_text_file(spark, str(path)).orderBy("pos").collect()
    assert [r.value for r in rows] == want


@pytest.fixture(scope="module")
def prepared(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    prepare.prepare_corpus(docs, path, "wikipedia", vocabulary_size=2_000, ratio=0.02, multiplier=1)
    return path


def test_prepared_corpus(spark, docs, prepared):
    shards = token_store.read_shards(spark, prepared)
    rows = shards.orderBy("split", "start").collect()
    assert len(rows) == docs.count()
    assert sum(r.split == "val" for r in rows) == 4
    for split in ("train", "val"):
        at = 0
        for row in (r for r in rows if r.split == split):
            assert row.start == at and row["size"] == len(row.tokens)
            assert row.tokens[0] == 1992 and row.tokens[-1] == 1999
            at += row["size"]
        meta = token_store.read_metadata(spark, prepared).first()
        assert meta["size"][split] == at
    index = token_store.read_index(spark, prepared)
    kept = ["split", "doc_id", "start", "size"]
    assert index.select(kept).exceptAll(shards.select(kept)).isEmpty()
    assert meta.name == "wikipedia" and meta.multiplier == 1.0


def test_raw_export(spark, prepared, tmp_path):
    shards = token_store.read_shards(spark, prepared)
    assert token_store.export_raw(shards, str(tmp_path / "raw")) == "uint16"
    for split in ("train", "val"):
        rows = shards.filter(F.col("split") == split).orderBy("start").collect()
        files = sorted(glob.glob(f"{tmp_path}/raw/{split}/*.bin"))
        got = np.concatenate([np.fromfile(f, "<u2") for f in files])
        assert got.tolist() == [t for r in rows for t in r.tokens]
    assert sorted(os.listdir(tmp_path / "raw")) == ["train", "val"]


def test_raw_export_checks_the_width(spark, tmp_path):
    wide = spark.createDataFrame(
        [("train", 0, 0, [1, 70_000])], "split string, shard int, start long, tokens array<int>"
    )
    with pytest.raises(ValueError):
        token_store.export_raw(wide, str(tmp_path / "raw"), dtype="uint16")
    assert token_store.export_raw(wide, str(tmp_path / "raw")) == "uint32"
    (file,) = glob.glob(f"{tmp_path}/raw/train/*.bin")
    assert np.fromfile(file, "<u4").tolist() == [1, 70_000]


def test_stream_equals_batch(spark, docs, tmp_path):
    arriving = tmp_path / "in"
    docs.repartition(3).write.parquet(str(arriving))
    cleaned = streaming.clean_arrivals(spark, str(arriving), ratio=0.2, seed=1, min_size=50)
    out = str(tmp_path / "out")
    streaming.append_to(cleaned, out, str(tmp_path / "check")).trigger(
        availableNow=True
    ).start().awaitTermination()
    batch = layout.hash_split(prepare.clean_documents(docs, min_size=50), 0.2, 1)
    found = spark.read.parquet(out).select(batch.columns)
    assert found.count() == batch.count() and found.exceptAll(batch).isEmpty()


def test_shared_folder_follows_the_session(spark, tmp_path):
    class Named:
        conf = {"spark.checkpoint.dir": str(tmp_path)}

    assert session.shared_folder(Named) == str(tmp_path)
    folder = session.shared_folder(spark)
    assert session.shared_folder(spark) == folder
    held = session.stored(spark.range(5), "five")
    assert held.count() == 5
    assert all(folder.split(":")[-1] in path for path in held.inputFiles())


def streams(spark, tmp_path, lengths, dtype=None):
    """A stored split of documents of the given lengths, exported raw; returns its path and tokens."""
    rows, at = [], 0
    for i, n in enumerate(lengths):
        rows.append(("train", i % 3 + 3 * (i * 3 // len(lengths)), i, at, n, [(i * 7919 + k) % 50_000 for k in range(n)]))
        at += n
    placed = spark.createDataFrame(rows, "split string, shard int, doc_id long, start long, size int, tokens array<int>")
    path = str(tmp_path / "raw")
    used = token_store.export_raw(placed.repartition(4), path, dtype)
    return path, used, placed, [t for r in rows for t in r[-1]]


@pytest.mark.parametrize("dtype", ["uint16", "uint32"])
@pytest.mark.parametrize("bytes_per_task, tokens_per_row", [(1 << 26, 1 << 16), (1_001, 64), (203, 7)])
def test_raw_files_by_byte_ranges(spark, tmp_path, dtype, bytes_per_task, tokens_per_row):
    path, used, _, stream = streams(spark, tmp_path, [0, 5, 300, 1, 0, 77, 900], dtype)
    found = token_store.read_raw(spark, path, used, tokens_per_row, bytes_per_task)
    rows = sorted(found.collect(), key=lambda r: r.start)
    assert [t for r in rows for t in r.tokens] == stream
    at = 0
    for r in rows:
        assert r.split == "train" and r.start == at and 0 < len(r.tokens) <= tokens_per_row
        at += len(r.tokens)


def test_large_raw_file_is_read_by_several_tasks(spark, tmp_path):
    folder = tmp_path / "raw" / "train"
    folder.mkdir(parents=True)
    ids = np.arange(5_000_000, dtype=np.uint32) % 50_000
    ids.astype("<u2").tofile(folder / "00000-00000000000000000000.bin")
    found = token_store.read_raw(spark, str(tmp_path / "raw"), bytes_per_task=1 << 20)
    assert found.rdd.getNumPartitions() == 10
    total = found.select(F.size("tokens").alias("n"), F.aggregate("tokens", F.lit(0).cast("long"), lambda a, b: a + b).alias("s"))
    row = total.agg(F.sum("n"), F.max("n"), F.sum("s")).first()
    assert tuple(row) == (len(ids), token_store.TOKENS_PER_ROW, int(ids.sum(dtype=np.int64)))


def test_raw_files_must_hold_whole_ids(spark, tmp_path):
    folder = tmp_path / "raw" / "val"
    folder.mkdir(parents=True)
    (folder / "00000-00000000000000000000.bin").write_bytes(b"\x01\x02\x03")
    with pytest.raises(Exception, match="no whole number"):
        token_store.read_raw(spark, str(tmp_path / "raw")).collect()
    (tmp_path / "none").mkdir()
    assert token_store.read_raw(spark, str(tmp_path / "none"), "uint32").count() == 0


def test_documents_from_raw_files_by_index(spark, tmp_path):
    """Ranges inside a file, over several files, empty ones, and one that no file holds."""
    path, used, placed, stream = streams(spark, tmp_path, [3, 0, 40, 500, 1, 9, 200])
    index = placed.select("split", "doc_id", "start", "size")
    found = {r.doc_id: r.tokens for r in token_store.raw_tokens_at(spark, path, index, used).collect()}
    assert found == {r.doc_id: r.tokens for r in placed.collect()}
    across = spark.createDataFrame([("train", 1, 2, 600)], "split string, doc_id long, start long, size int")
    assert token_store.raw_tokens_at(spark, path, across, used).first().tokens == stream[2:602]
    beyond = spark.createDataFrame([("train", 1, 700, 600)], "split string, doc_id long, start long, size int")
    with pytest.raises(Exception, match="lack token"):
        token_store.raw_tokens_at(spark, path, beyond, used).collect()


def test_tokens_by_id_open_only_their_shards(spark, prepared):
    shards = token_store.read_shards(spark, prepared)
    every = {r.doc_id: r for r in shards.collect()}
    ids = sorted(every)[5:200:40]
    for asked in ([*ids, ids[0], -1], spark.createDataFrame([(i,) for i in [*ids, ids[0], -1]], "doc_id long")):
        found = token_store.tokens_at(spark, prepared, asked)
        rows = found.collect()
        assert sorted(r.doc_id for r in rows) == ids
        assert all(r.tokens == every[r.doc_id].tokens and r.start == every[r.doc_id].start for r in rows)
    for asked in (ids[:1], spark.createDataFrame([(ids[0],)], "doc_id long")):
        plan = token_store.tokens_at(spark, prepared, asked)._jdf.queryExecution().executedPlan().toString()
        (scan,) = [x for x in plan.split("\n") if "/shards" in x]
        assert "shard#" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert token_store.tokens_at(spark, prepared, [], "val").count() == 0


def test_shards_are_written_once(spark, tmp_path):
    """About one file a shard, however many tasks there are."""
    rows = [("train" if i % 5 else "val", i, 10 + i % 3, list(range(10 + i % 3))) for i in range(400)]
    encoded = spark.createDataFrame(rows, "split string, doc_id long, size int, tokens array<int>").repartition(8)
    path = str(tmp_path / "corpus")
    shards = token_store.save_corpus(encoded, path, "x", max_shards=16)
    files = glob.glob(f"{path}/shards/*/*/*.parquet")
    folders = {os.path.dirname(f) for f in files}
    assert len(folders) == 32 and len(files) <= 32 + 2 * spark.sparkContext.defaultParallelism
    assert shards.count() == 400 and sorted(os.listdir(path)) == ["index", "metadata", "shards"]


ENDS = ["", "\n", "a", "\na\r\nb\r\n", "\ufeffa\nb", "\ufeff", "é x\x85y\n\n日本\n" + "x" * 5_000 + "\n" + "y" * 3_000]


@pytest.mark.parametrize("ranges", [1, 4, 16])
def test_text_file_by_byte_ranges(spark, tmp_path, ranges):
    contents = [*(ENDS if ranges == 4 else ENDS[-1:]), "\n".join(f"line {i}" * (i % 9) for i in range(2_000))]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for k, content in enumerate(contents):
            path = tmp_path / f"{k}.txt"
            path.write_bytes(content.encode())
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(len(content.encode()) // ranges + 1, 512)))
            rows = text_array.load_text_file(spark, str(path)).collect()
            assert [r.value for r in sorted(rows)] == content.split("\n")
            assert sorted(r.pos for r in rows) == list(range(len(rows)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ids_by_position_do_not_follow_splits(spark, tmp_path):
    """Lines, JSON and parquet rows without a key have the same ids however files are cut."""
    rows = [(f"text {i} " * (i % 50), "x") for i in range(600)]
    frame = spark.createDataFrame(rows, "body string, source string").coalesce(1)
    frame.select("body").write.text(str(tmp_path / "text"))
    frame.write.json(str(tmp_path / "json"))
    for part in range(2):
        frame.write.mode("append").option("parquet.block.size", 4_096).parquet(str(tmp_path / f"parquet/{part}"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for fmt, place in (("text", "text"), ("json", "json"), ("parquet", "parquet/*")):
            found = []
            for size in ("134217728", "2973"):
                spark.conf.set("spark.sql.files.maxPartitionBytes", size)
                options = {} if fmt == "text" else {"text_col": "body", "id_col": None}
                docs = corpus.read_corpus(spark, str(tmp_path / place), None if fmt != "text" else "t", fmt, **options)
                assert docs.columns == ["doc_id", "source", "text"]
                found.append(sorted((r.doc_id, r.text) for r in docs.collect()))
            assert found[0] == found[1]
            assert [i for i, _ in found[0]] == list(range(len(found[0])))
            assert [t for _, t in found[0]][:600] == [b for b, _ in rows]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_scope_deletes_what_was_stored_inside(spark, tmp_path):
    outside = session.stored(spark.range(3), "outside")
    with pytest.raises(RuntimeError), session.scope(spark):
        inner = session.stored(spark.range(5).withColumn("x", F.col("id") + 1), "inner")
        (place,) = {os.path.dirname(f.removeprefix("file:").replace("//", "/")) for f in inner.inputFiles()}
        inner.write.parquet(str(tmp_path / "result"))
        assert os.path.isdir(place)
        raise RuntimeError
    assert not os.path.exists(place)
    assert outside.count() == 3 and spark.read.parquet(str(tmp_path / "result")).count() == 5
