"""Tables of training-run metrics, one row per save."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill import tables
from textmill.operators.ordering import null_safe_join

# Fields of one record (fixed values), next to the run and its time stamp.
FIELDS = [
    "time",
    "iter",
    "tokens",
    "epochs",
    "accuracy",
    "loss",
    "val_accuracy",
    "val_loss",
    "best_val_loss",
]
RECORD_SCHEMA = (
    "run string, ts timestamp, time double, iter long, tokens long, epochs long, "
    "accuracy double, loss double, val_accuracy double, val_loss double, best_val_loss double"
)
ITERATIONS_PER_BUCKET = 1_000_000


def as_records(metrics: DataFrame) -> DataFrame:
    """The nine fields with run and time stamp, in their types; fields that are missing are null."""
    fields = T.StructType.fromDDL(RECORD_SCHEMA)
    return metrics.select(
        *[
            (F.col(f.name) if f.name in metrics.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in fields
        ]
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The records of a metric table."""
    return spark.read.schema(RECORD_SCHEMA).parquet(path)


def append_metrics(records: DataFrame, path: str) -> None:
    """Add records to a metric table."""
    records.write.mode("append").parquet(path)


def _bucketed(records: DataFrame, iteration: str, per_bucket: int) -> DataFrame:
    return records.withColumn("_bucket", F.floor(F.col(iteration) / per_bucket))


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def with_elapsed(
    records: DataFrame,
    run: str = "run",
    iteration: str = "iter",
    ts: str = "ts",
    per_bucket: int = ITERATIONS_PER_BUCKET,
) -> DataFrame:
    """Add ``elapsed``: seconds since the previous save of the run, null for the first.

    Runs are worked on in stretches of iterations; the last time of each stretch is
    handed to the next one, so a run with most of the rows is no single task.
    """
    parts = _bucketed(records, iteration, per_bucket)
    last = parts.groupBy(run, "_bucket").agg(F.max_by(ts, iteration).alias("_last"))
    handed = last.select(
        run,
        "_bucket",
        F.lag("_last").over(Window.partitionBy(run).orderBy("_bucket")).alias("_before"),
    )
    previous = F.lag(ts).over(Window.partitionBy(run, "_bucket").orderBy(iteration))
    # the join and the window share one partitioning
    return (
        null_safe_join(parts, handed, [run, "_bucket"])
        .withColumn("_previous", F.coalesce(previous, F.col("_before")))
        .withColumn(
            "elapsed", (_micros(ts) - _micros("_previous")) / F.lit(1e6)
        )
        .select(*records.columns, "elapsed")
    )


def with_running_best(
    records: DataFrame,
    value: str = "val_loss",
    run: str = "run",
    iteration: str = "iter",
    name: str = "best_val_loss",
    per_bucket: int = ITERATIONS_PER_BUCKET,
) -> DataFrame:
    """Add the smallest ``value`` of the run up to and with each row."""
    parts = _bucketed(records, iteration, per_bucket)
    best = parts.groupBy(run, "_bucket").agg(F.min(value).alias("_best"))
    earlier = Window.partitionBy(run).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    handed = best.select(run, "_bucket", F.min("_best").over(earlier).alias("_before"))
    upto = (
        Window.partitionBy(run, "_bucket")
        .orderBy(iteration)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    kept = [c for c in records.columns if c != name]
    return (
        null_safe_join(parts, handed, [run, "_bucket"])
        .withColumn("_here", F.min(value).over(upto))
        .select(*kept, F.least("_here", "_before").alias(name))
    )


def latest_metrics(
    records: DataFrame,
    fields: list[str] | None = None,
    run: str = "run",
    iteration: str = "iter",
    val_loss: str = "val_loss",
) -> DataFrame:
    """What a run resumes from: its last value per field and its best validation loss."""
    fields = [f for f in FIELDS if f in records.columns] if fields is None else fields
    values = [
        F.max_by(field, iteration).alias(field)
        for field in fields
        if field not in (iteration, "best_val_loss")
    ]
    return records.groupBy(run).agg(
        F.max(iteration).alias(iteration), *values, F.min(val_loss).alias("best_val_loss")
    )


def epoch_losses(
    records: DataFrame, run: str = "run", epoch: str = "epochs", loss: str = "loss"
) -> DataFrame:
    """Mean batch loss per epoch."""
    return records.groupBy(run, epoch).agg(
        F.avg(loss).alias("epoch_loss"), F.count(loss).alias("batches")
    )


def validation_rows(
    records: DataFrame, step: int = tables.VALIDATION_STEP, iteration: str = "iter"
) -> DataFrame:
    """Rows at which a validation is due."""
    return records.filter(F.col(iteration) % step == 0)
