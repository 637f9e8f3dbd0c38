"""Session settings and stored intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs rely on for even work; sizes are left to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", name: str = "textmill", **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in {**SETTINGS, **defaults, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where none is set, as in tests on one machine, a temporary one is made and set; a cluster without
    the setting is refused, since its executors share no local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="textmill-"))
    return context.getCheckpointDir()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Folders that :func:`stored` has written and no :func:`scope` has deleted.
_STORED: list[str] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end all intermediate tables that were stored inside, also after an error.

    What is to stay must be written before the end: a lazy result still reads those tables.
    """
    begin = len(_STORED)
    try:
        yield
    finally:
        paths = _STORED[begin:]
        del _STORED[begin:]
        for path in paths:
            discard(spark, path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go once it is written, not when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table that several later steps read, and read it back.

    Cuts the lineage, survives lost executors and lets each reader load only its columns. The table stays until the
    :func:`scope` around it ends, or :func:`release` deletes it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _STORED.append(path)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    held = spark.read.schema(df.schema).parquet(path)
    held._stored_at = path
    return held


def release(held: DataFrame) -> None:
    """Delete a table that :func:`stored` returned, once nothing that reads it is to be computed any more."""
    path = held._stored_at
    discard(held.sparkSession, path)
    if path in _STORED:
        _STORED.remove(path)
