"""Starting streams, bounded runs, and sinks that survive a replayed batch.

A batch may be written twice after a failure, so every sink writes batch N to
``batch_id=N`` and replaces what is there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from gristmill.sources import rolled

AVAILABLE = {"availableNow": True}


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def start(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a stream into a per-batch sink."""
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE))
        .start()
    )


def finish(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait for a bounded run; an overdue one is stopped and reported."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream not done after {seconds} s")


def batches_done(query: StreamingQuery) -> int:
    """How many batches a stream has worked off, earlier runs on its checkpoint included."""
    done = query.lastProgress
    return done["batchId"] + 1 if done else 0


def write_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
    order: Sequence = (),
    format: str = "parquet",
    per_file: int | None = None,
) -> StreamingQuery:
    """Write each batch below ``path``, sorted inside the batch if asked to."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.orderBy(*order) if order else batch
        writer = rows.write.mode("overwrite").format(format)
        if per_file:
            writer = writer.option("maxRecordsPerFile", per_file)
        writer.save(batch_path(path, batch_id))

    return start(stream, sink, checkpoint, mode, trigger)


def to_console(
    stream: DataFrame, checkpoint: str, mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Print each batch in full width."""
    return (
        stream.writeStream.outputMode(mode)
        .format("console")
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE))
        .start()
    )


def to_csv(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "1 minute",
    per_file: int = 10_000,
) -> StreamingQuery:
    """Append csv files, a new set per interval and a new file after ``per_file``
    rows; ``every=None`` works off what is available and ends."""
    writer: DataStreamWriter = (
        stream.writeStream.outputMode("append")
        .format("csv")
        .option("path", path)
        .option("maxRecordsPerFile", per_file)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else AVAILABLE
    return writer.trigger(**trigger).start()


def to_rolled(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = "1 minute", **options
) -> StreamingQuery:
    """Append files that end at a size or an age (``sources.rolled``), with names of one's own;
    ``every=None`` works off what is available and ends."""
    rolled.register(stream.sparkSession)
    writer = stream.writeStream.outputMode("append").format("rolled").options(path=path, **options)
    trigger = {"processingTime": every} if every else AVAILABLE
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_batches(
    spark: SparkSession, path: str, schema: StructType, format: str = "parquet"
) -> DataFrame:
    """All batches below ``path`` with their ``batch_id``."""
    full = StructType([*schema.fields]).add("batch_id", "long")
    return spark.read.schema(full).format(format).load(path)


def last_batch(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Result of a complete-mode stream: its newest batch. The batch number is a
    partition column, so older batches are not read."""
    batches = read_batches(spark, path, schema)
    newest = batches.agg(F.max("batch_id")).scalar()
    return batches.where(F.col("batch_id") == newest).drop("batch_id")


def last_per_key(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]
) -> DataFrame:
    """Result of an update-mode stream: the newest row of each key."""
    batches = read_batches(spark, path, schema)
    rest = [f.name for f in schema.fields if f.name not in keys]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("row")
    return batches.groupBy(*keys).agg(newest).select(*keys, "row.*")
