"""Stored corpora: token shards, offset index, metadata, raw token files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from textmill import tables
from textmill.operators import layout, narrow, vocabulary
from textmill.session import discard, shuffles_dropped

TOKENS_PER_TASK = 1 << 24  # of a stream that one task writes
BYTES_PER_TASK = 1 << 26  # of raw token files that one task reads
TOKENS_PER_ROW = 1 << 16  # of a row of raw tokens


def write_shards(
    placed: DataFrame, path: str, tokens_per_task: int = TOKENS_PER_TASK, dealt: bool = False
) -> None:
    """Token shards of a table from :func:`layout.offsets`.

    One folder per split and shard, rows in stream order inside each file. Rows are dealt by stretches of equal
    token counts of the streams, so a task owns neighbouring shards or a part of one: there are about as many
    files as shards, and shards are written side by side. ``dealt`` says that rows stand so already, as
    ``tokens_per_bucket`` of :func:`layout.offsets` leaves them.
    """
    rows = placed.select("split", "shard", "start", "doc_id", "size", "tokens")
    if dealt:
        rows.sortWithinPartitions("split", "shard", "start").write.mode("overwrite").option(
            "compression", "zstd"
        ).partitionBy("split", "shard").parquet(path)
        return
    # one row per split
    sizes = placed.groupBy("split").agg(F.max(F.col("start") + F.col("size")).alias("n")).collect()
    cores = placed.sparkSession.sparkContext.defaultParallelism
    total = sum(r.n or 0 for r in sizes)
    stretch = max(1, min(tokens_per_task, -(-total // cores)))
    first, parts = F.lit(0), 0
    for r in sorted(sizes, key=lambda r: (r.split is None, r.split or "")):
        first = F.when(F.col("split").eqNullSafe(F.lit(r.split)), parts).otherwise(first)
        parts += -(-(r.n or 0) // stretch) or 1
    owner = (first + F.floor(F.col("start") / stretch)).cast("int")
    dealt = rows.withColumn("_owner", owner).repartitionById(max(parts, 1), "_owner").drop("_owner")
    dealt.sortWithinPartitions("split", "shard", "start").write.mode("overwrite").partitionBy(
        "split", "shard"
    ).parquet(path)


def write_index(placed: DataFrame, path: str) -> None:
    """Offset index: where each document starts in its split, how long it is and which shard has it.

    Files hold ranges of ids in order, so that a lookup by id skips the others by their statistics.
    """
    rows = placed.select("split", "doc_id", "start", "size", "shard")
    rows.repartitionByRange("split", "doc_id").sortWithinPartitions("split", "doc_id").write.mode(
        "overwrite"
    ).partitionBy("split").parquet(path)


def write_metadata(metadata: DataFrame, path: str) -> None:
    """The one-row description, as JSON."""
    metadata.coalesce(1).write.mode("overwrite").json(path)


def save_corpus(
    encoded: DataFrame,
    path: str,
    name: str,
    training_part: str = "pretraining",
    multiplier: float = tables.DEFAULT_MULTIPLIER,
    max_shards: int = tables.MAX_SHARDS,
    held: bool = False,
) -> DataFrame:
    """Store ``(doc_id, split, tokens, size)`` under ``path`` and return the shards.

    ``encoded`` is computed once, into ``encoded/``; index, shards and metadata are made
    from there, and it is deleted when they are written. ``held`` says that it is a stored table already, which is read as it is.
    """
    spark = encoded.sparkSession
    encoded = encoded.select("doc_id", "split", "size", "tokens")
    with shuffles_dropped(spark):
        if not held:
            encoded.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/encoded")
            encoded = spark.read.parquet(f"{path}/encoded")
        total = encoded.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0
        stretch = max(1, min(TOKENS_PER_TASK, -(-total // spark.sparkContext.defaultParallelism)))
        # tokens move once, to the stretch of their stream, and are written from there
        short, widened = narrow.narrowed(encoded, "tokens")
        placed = widened(layout.offsets(short, max_shards=max_shards, tokens_per_bucket=stretch))
        write_shards(placed, f"{path}/shards", dealt=True)
        shards = read_shards(spark, path)
        write_index(shards, f"{path}/index")
        sizes = layout.split_sizes(encoded, text=None)
        write_metadata(
            layout.metadata(sizes, name, training_part, multiplier), f"{path}/metadata"
        )
    if not held:
        discard(spark, f"{path}/encoded")
    return shards


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/shards")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def _looked_up(index: DataFrame, ids: Sequence[int] | DataFrame, split: str | None) -> DataFrame:
    """Index rows of the ids asked for."""
    if split is not None:
        index = index.filter(F.col("split") == split)
    if isinstance(ids, DataFrame):
        return index.join(ids.select(F.col("doc_id").cast("long")).distinct(), "doc_id")
    return index.filter(F.col("doc_id").isin([int(i) for i in ids]))


def tokens_at(
    spark: SparkSession, path: str, ids: Sequence[int] | DataFrame, split: str | None = None
) -> DataFrame:
    """``(split, doc_id, start, size, tokens)`` of documents of a stored corpus, found by the offset index.

    The index says which shards hold the ids; only their folders are opened. ``ids`` is a list, or a table of any size
    with a column ``doc_id``. Ids that the corpus lacks give no row, repeated ones a single one for each document.
    """
    found = _looked_up(read_index(spark, path), ids, split)
    # no more rows than the corpus has shards, whatever is asked
    places = found.select("split", "shard").distinct().collect()
    inside = F.lit(False)
    for name in {r.split for r in places}:
        own = [r.shard for r in places if r.split == name]
        inside = inside | (F.col("split").eqNullSafe(F.lit(name)) & F.col("shard").isin(own))
    opened = read_shards(spark, path).filter(inside)
    if isinstance(ids, DataFrame):
        # the place in its split's stream is a document's key, but for empty ones; an empty split is stored as null
        named = F.coalesce("split", F.lit("")).alias("_split")
        wanted = found.select(named, "shard", "start", "doc_id")
        opened = opened.withColumn("_split", named).join(wanted, ["_split", "shard", "start", "doc_id"], "leftsemi")
    else:
        opened = opened.filter(F.col("doc_id").isin([int(i) for i in ids]))
    return opened.select("split", "doc_id", "start", "size", "tokens")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "training_part string, name string, size map<string,bigint>, multiplier double"
    )
    return spark.read.schema(schema).json(f"{path}/metadata")


def _raw_token_source() -> type[DataSource]:
    # classes made in a function travel by value: executors need not have this package

    class RawTokenWriter(DataSourceArrowWriter):
        """Little-endian ids, one file per shard and task, moved into place on commit."""

        def __init__(self, options, overwrite):
            import uuid

            self.overwrite = overwrite
            self.path = options["path"].rstrip("/")
            self.dtype = options.get("dtype", "uint32")
            self.attempts = f"{self.path}/_attempts-{uuid.uuid4().hex}"

        def _files(self):
            from pyarrow import fs

            if "://" in self.path or self.path.startswith("file:"):
                system, _ = fs.FileSystem.from_uri(self.path)
                return system, lambda p: fs.FileSystem.from_uri(p)[1]
            return fs.LocalFileSystem(), lambda p: p

        def write(self, iterator):
            import uuid
            from contextlib import ExitStack

            import numpy as np

            import pyarrow as pa
            import pyarrow.compute as pc

            system, local = self._files()
            folder = f"{self.attempts}/{uuid.uuid4().hex}"
            system.create_dir(local(folder), recursive=True)
            limit = np.iinfo(self.dtype).max
            written: list[tuple[str, str]] = []
            place = stream = None
            with ExitStack() as stack:
                for batch in iterator:
                    table = pa.Table.from_batches([batch]).combine_chunks()
                    if not table.num_rows:
                        continue
                    split, shard = table["split"], table["shard"]
                    # rows of one file stand together: where the file changes, a run ends
                    changes = pc.or_(
                        pc.not_equal(split.slice(1), split.slice(0, len(split) - 1)),
                        pc.not_equal(shard.slice(1), shard.slice(0, len(shard) - 1)),
                    ).to_numpy()
                    begins = [0, *(np.flatnonzero(changes) + 1).tolist()]
                    for begin, end in zip(begins, [*begins[1:], table.num_rows]):
                        here = (split[begin].as_py(), shard[begin].as_py())
                        if here != place:
                            if stream is not None:
                                stream.close()
                            place = here
                            made = f"{folder}/{len(written):08d}"
                            start = table["start"][begin].as_py()
                            written.append((made, f"{here[0]}/{here[1]:05d}-{start:020d}.bin"))
                            stream = stack.enter_context(
                                system.open_output_stream(local(made))
                            )
                        rows = table["tokens"].slice(begin, end - begin)
                        for chunk in rows.chunks:
                            ids = chunk.flatten().to_numpy(zero_copy_only=False)
                            if len(ids) and (ids.max() > limit or ids.min() < 0):
                                raise ValueError(f"token id does not fit {self.dtype}")
                            little = np.dtype(self.dtype).newbyteorder("<")
                            stream.write(ids.astype(little).tobytes())

            class Written(WriterCommitMessage):
                files = None

            message = Written()
            message.files = written
            return message

        def commit(self, messages):
            from concurrent.futures import ThreadPoolExecutor

            from pyarrow import fs

            system, local = self._files()
            if self.overwrite:  # what an earlier export left would be part of the stream
                here = fs.FileSelector(local(self.path), allow_not_found=True)
                for info in system.get_file_info(here):
                    if info.type == fs.FileType.Directory and info.base_name[:10] != "_attempts-":
                        system.delete_dir(info.path)
            moves = [
                (local(made), local(f"{self.path}/{final}"))
                for message in messages
                if message is not None
                for made, final in message.files
            ]
            for folder in {target.rsplit("/", 1)[0] for _, target in moves}:
                system.create_dir(folder, recursive=True)
            with ThreadPoolExecutor(16) as pool:
                list(pool.map(lambda move: system.move(*move), moves))
            self._drop_attempts(system, local)

        def abort(self, messages):
            self._drop_attempts(*self._files())

        def _drop_attempts(self, system, local):
            from pyarrow import fs

            if system.get_file_info(local(self.attempts)).type == fs.FileType.Directory:
                system.delete_dir(local(self.attempts))

    class Stretches(InputPartition):
        """Byte ranges ``(path, split, first token, offset, bytes)`` that one task reads."""

        def __init__(self, ranges):
            super().__init__(ranges)

    class RawTokenReader(DataSourceReader):
        """Token files by byte ranges: a large file is read by several tasks, small ones by one."""

        def __init__(self, options):
            self.path = options["path"].rstrip("/")
            self.dtype = options.get("dtype", "uint32")
            self.bytes_per_task = int(options["bytes_per_task"])
            self.tokens_per_row = int(options["tokens_per_row"])

        def _files(self):
            from pyarrow import fs

            if "://" in self.path or self.path.startswith("file:"):
                return fs.FileSystem.from_uri(self.path)
            return fs.LocalFileSystem(), self.path

        def partitions(self):
            import re

            import numpy as np

            from pyarrow import fs

            system, top = self._files()
            width = np.dtype(self.dtype).itemsize
            step = max(self.bytes_per_task // width, 1) * width
            tasks, ranges, held = [], [], 0
            for info in sorted(system.get_file_info(fs.FileSelector(top, recursive=True)), key=lambda f: f.path):
                place = re.search(r"([^/]+)/\d+-(\d+)\.bin$", info.path)
                if info.type != fs.FileType.File or place is None or "/_attempts-" in info.path:
                    continue
                if info.size % width:
                    raise ValueError(f"{info.path}: {info.size} bytes are no whole number of {self.dtype} ids")
                for at in range(0, info.size, step):
                    size = min(step, info.size - at)
                    if ranges and held + size > step:
                        tasks.append(Stretches(ranges))
                        ranges, held = [], 0
                    ranges.append((info.path, place[1], int(place[2]) + at // width, at, size))
                    held += size
            return [*tasks, Stretches(ranges)]

        def read(self, partition):
            import numpy as np

            import pyarrow as pa

            system, _ = self._files()
            kind = np.dtype(self.dtype).newbyteorder("<")
            most = self.tokens_per_row * kind.itemsize
            names = ["split", "shard", "start", "tokens"]
            for path, split, start, offset, size in partition.value:
                shard = int(path.rsplit("/", 1)[1].split("-")[0])
                with system.open_input_file(path) as file:
                    for at in range(0, size, most):
                        data = file.read_at(min(most, size - at), offset + at)
                        ids = np.frombuffer(data, kind)
                        if kind.itemsize == 4 and len(ids) and ids.max() > np.iinfo(np.int32).max:
                            raise ValueError(f"{path}: a token id beyond 31 bits")
                        values = pa.array(ids.astype(np.int32))
                        tokens = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), values)
                        first = start + at // kind.itemsize
                        row = [pa.array([split]), pa.array([shard], pa.int32()), pa.array([first], pa.int64()), tokens]
                        yield pa.RecordBatch.from_arrays(row, names=names)

    class RawTokens(DataSource):
        @classmethod
        def name(cls):
            return "raw_tokens"

        def schema(self):
            return "split string, shard int, start bigint, tokens array<int>"

        def writer(self, schema, overwrite):
            return RawTokenWriter(dict(self.options), overwrite)

        def reader(self, schema):
            return RawTokenReader(dict(self.options))

    return RawTokens


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the default file system if it names none."""
    if ":" in path.split("/")[0]:
        return path
    default = spark.conf.get("spark.hadoop.fs.defaultFS", "file:///").rstrip("/")
    return path if default in ("", "file:") else f"{default}{path}"


def export_raw(placed: DataFrame, path: str, dtype: str | None = None) -> str:
    """Write plain token files ``<split>/<shard>-<start>.bin``; returns the id type.

    The files of a split in name order are its token stream; they replace those of an earlier
    export. A path without a scheme belongs to the cluster's default file system. Without ``dtype`` the
    narrowest type that holds every id is taken; one that is too narrow is refused.
    """
    width = vocabulary.id_width(placed).first()
    if dtype is None:
        dtype = width["dtype"]
    elif dtype not in ("uint16", "uint32"):
        raise ValueError("dtype must be uint16 or uint32")
    elif dtype == "uint16" and width["dtype"] != "uint16":
        raise ValueError(f"largest token id {width['max_id']} does not fit uint16")
    spark = placed.sparkSession
    spark.dataSource.register(_raw_token_source())
    rows = placed.select("split", "shard", "start", "tokens")
    rows.repartitionByRange("split", "start").sortWithinPartitions("split", "start").write.format(
        "raw_tokens"
    ).mode("overwrite").option("dtype", dtype).save(_qualified(spark, path))
    return dtype


def _check_dtype(dtype: str) -> None:
    if dtype not in ("uint16", "uint32"):
        raise ValueError("dtype must be uint16 or uint32")


def read_raw(
    spark: SparkSession,
    path: str,
    dtype: str = "uint16",
    tokens_per_row: int = TOKENS_PER_ROW,
    bytes_per_task: int = BYTES_PER_TASK,
) -> DataFrame:
    """``(split, start, tokens)`` of the files of :func:`export_raw`, ``tokens_per_row`` ids a row at most.

    ``start`` is the place of the row's first token in the stream of its split. Tasks read byte ranges, cut
    between ids: a file of any size is spread, and no task holds more than a row of it.
    """
    _check_dtype(dtype)
    spark.dataSource.register(_raw_token_source())
    rows = (
        spark.read.format("raw_tokens")
        .option("dtype", dtype)
        .option("tokens_per_row", str(tokens_per_row))
        .option("bytes_per_task", str(bytes_per_task))
        .load(_qualified(spark, path))
    )
    return rows.select("split", "start", "tokens")


def raw_tokens_at(
    spark: SparkSession, path: str, index: DataFrame, dtype: str = "uint16"
) -> DataFrame:
    """``(split, doc_id, start, size, tokens)``: the index rows with their tokens from the raw files.

    Each row is a byte range of its split's stream: only those bytes are read, wherever a file ends. The list
    of files, one name and start each, goes to every task.
    """
    import bisect

    import numpy as np

    _check_dtype(dtype)
    place = _qualified(spark, path)

    def files():
        from pyarrow import fs

        if "://" in place or place.startswith("file:"):
            return fs.FileSystem.from_uri(place)
        return fs.LocalFileSystem(), place

    def listed():
        import re

        from pyarrow import fs

        system, top = files()
        streams: dict[str, list[tuple[int, int, str]]] = {}
        for info in system.get_file_info(fs.FileSelector(top, recursive=True)):
            name = re.search(r"([^/]+)/\d+-(\d+)\.bin$", info.path)
            if name is not None and "/_attempts-" not in info.path:
                tokens = info.size // np.dtype(dtype).itemsize
                streams.setdefault(name[1], []).append((int(name[2]), int(name[2]) + tokens, info.path))
        return {split: sorted(x) for split, x in streams.items()}

    shared = spark.sparkContext.broadcast(listed())

    def run(batches):
        import pyarrow as pa

        system, _ = files()
        kind = np.dtype(dtype).newbyteorder("<")
        streams = shared.value
        for batch in batches:
            found = []
            for split, start, size in zip(*[batch.column(batch.schema.names.index(c)).to_pylist() for c in ("split", "start", "size")]):
                parts, at, end = [], start, start + (size or 0)
                known = streams.get(split, [])
                k = max(bisect.bisect_right(known, (start, float("inf"), "")) - 1, 0)
                while at < end:
                    if k >= len(known) or not known[k][0] <= at:
                        raise ValueError(f"the raw files of {split} lack token {at}")
                    if at < known[k][1]:
                        stop = min(end, known[k][1])
                        with system.open_input_file(known[k][2]) as file:
                            data = file.read_at((stop - at) * kind.itemsize, (at - known[k][0]) * kind.itemsize)
                        parts.append(np.frombuffer(data, kind).astype(np.int32))
                        at = stop
                    k += 1
                found.append(np.concatenate(parts) if parts else np.zeros(0, np.int32))
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            tokens = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int32), *found])))
            yield pa.RecordBatch.from_arrays([*batch.columns, tokens], names=[*batch.schema.names, "tokens"])

    rows = index.select("split", "doc_id", F.col("start").cast("long"), F.col("size").cast("int"))
    kind = index.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"split string, doc_id {kind}, start long, size int, tokens array<int>")
