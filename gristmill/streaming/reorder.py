"""Rows that come late, held until their turn.

A stream's rows carry a sequence number. Each batch is put together with the rows held so
far, and all rows up to the horizon go on, in one batch of their own. The horizon is

* the watermark: the largest number seen, less ``delay``. A row is never more than ``delay``
  behind, so no row below the horizon is missing; the rows held are those of the last
  ``delay`` numbers, however long the stream is; and
* with ``dense`` numbers, the last number before the first gap: such rows need not wait.

A row that still comes below an earlier horizon is not lost: it goes on at once, with
``late`` set. Rows without a number go on at once, and are late after the first batch.
Repeated numbers go on together. At the end of the input ``flush`` passes on what is held.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gristmill.operators.order import with_position
from gristmill.streaming import slots
from gristmill.streaming.runs import start

Sink = Callable[[DataFrame, int], None]
HORIZON = StructType().add("horizon", "long").add("newest", "long")


def _unbroken(pending: DataFrame, seq: str, after: Column) -> DataFrame:
    """One row: the last number of the run without a gap that follows ``after`` (null: that
    starts with the smallest number). Numbers and positions part at the first gap for good."""
    numbers = pending.select(F.col(seq).alias("_s")).where(F.col("_s").isNotNull()).distinct()
    placed = with_position(numbers, ["_s"], "_p")
    first = F.coalesce(after + 1, placed.agg(F.min("_s")).scalar())
    return placed.where(F.col("_s") == first + F.col("_p") - 1).agg(F.max("_s").alias("last"))


def release(
    spark: SparkSession, batch: DataFrame, batch_id: int, seq: str, delay: int, held: str, dense: bool, last: bool = False
) -> DataFrame:
    """The rows that go on with this batch, with ``late``; the others are left for the next one."""
    schema = batch.schema
    pending = slots.before(spark, f"{held}/rows", batch_id, schema).unionByName(batch).checkpoint()
    state = slots.before(spark, f"{held}/horizon", batch_id, HORIZON).first()
    old, newest = (state["horizon"], state["newest"]) if state else (None, None)
    top = pending.agg(F.max(F.col(seq).cast("long"))).first()[0]
    newest = max((x for x in (newest, top) if x is not None), default=None)
    horizon = old
    if newest is not None:
        bounds = [old, newest if last else newest - delay]
        if dense:
            waiting = pending if old is None else pending.where(F.col(seq) > old)
            bounds.append(_unbroken(waiting, seq, F.lit(old).cast("long")).first()["last"])
        horizon = max(x for x in bounds if x is not None)
    goes = F.col(seq).isNull()
    late = F.col(seq).isNull() & F.lit(batch_id > 0)
    if horizon is not None:
        goes = goes | (F.col(seq) <= horizon)
    if old is not None:
        late = late | (F.col(seq) <= old)
    slots.leave(pending.where(~goes), f"{held}/rows", batch_id)
    slots.leave(spark.createDataFrame([(horizon, newest)], HORIZON), f"{held}/horizon", batch_id)
    return pending.where(goes).withColumn("late", F.coalesce(late, F.lit(False)))


def in_order(
    stream: DataFrame,
    seq: str,
    delay: int,
    sink: Sink,
    held: str,
    checkpoint: str,
    dense: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Pass the stream on to ``sink`` in the order of ``seq``, batch by batch; a sink batch holds
    only numbers above those of the sink batches before, but for rows marked ``late``. ``held``
    keeps the waiting rows; a replayed batch passes on the same rows again."""
    spark = stream.sparkSession

    def step(batch: DataFrame, batch_id: int) -> None:
        sink(release(spark, batch, batch_id, seq, delay, held, dense), batch_id)

    return start(stream, step, checkpoint, "append", trigger)


def flush(spark: SparkSession, schema: StructType, seq: str, sink: Sink, held: str, batch_id: int) -> None:
    """Pass on what is held after the last batch ``batch_id - 1`` of an input that has ended."""
    none = spark.createDataFrame([], schema)
    sink(release(spark, none, batch_id, seq, 0, held, False, last=True), batch_id)
