"""Out-of-order detection on a stream: rows whose time lies before that of the
row ahead of them, in the order of a sequence number.

Inside a batch rows are compared with bucketed windows. The last row per key is carried
from batch to batch: batch N writes the rows of its own keys as delta N, and every
``COMPACT``-th batch folds the deltas into one table, so the carried state stays within
the keys ever seen plus the deltas since, whatever the number of batches. Older state than
the last two tables is removed. Batches must come in the order of the sequence, or go through
the reorder buffer; a row older than the last one carried is compared with that one. There is no Python and no task that
must hold all rows of a key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from gristmill.operators.order import with_previous
from gristmill.streaming import reorder
from gristmill.streaming.runs import batch_path, start

#: Batches after which the carried rows are folded into one table.
COMPACT = 10


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def sink_into(
    spark: SparkSession,
    schema: StructType,
    seq: str,
    ts: str,
    path: str,
    carry: str,
    keys: Sequence[str] = (),
    **options,
) -> Callable[[DataFrame, int], None]:
    """A batch sink that writes late rows with ``prev_ts`` below ``path``; ``carry`` holds the last
    row per key. Batch N reads what earlier batches left and replaces its own files."""
    keys = list(keys)
    types = {f.name: f.dataType for f in schema.fields}
    carried = StructType(
        [StructField(k, types[k]) for k in keys]
        + [StructField("_seq", types[seq]), StructField("_ts", types[ts])]
    )

    def same_key(left: DataFrame, right: DataFrame):
        match = F.lit(True)
        for k in keys:
            match = match & left[k].eqNullSafe(right[k])
        return match

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            base = (batch_id - 1) // COMPACT * COMPACT if batch_id else 0
            earlier = [batch_path(carry, n) for n in range(base, batch_id)]
            known = spark.createDataFrame([], carried)
            if earlier:
                newest = F.max_by(F.struct("_seq", "_ts"), "_seq").alias("last")
                read = spark.read.schema(carried).parquet(*earlier)
                known = read.groupBy(*keys).agg(newest).where("last IS NOT NULL").select(*keys, "last.*")
            firsts = batch.groupBy(*keys).agg(
                F.min(seq).alias("_first"),
                F.max(seq).alias("_seq"),
                F.max_by(ts, seq).alias("_ts"),
            ).where(F.col("_first").isNotNull())
            linked = with_previous(batch, ts, seq, keys, name="prev_ts", **options)
            # One row per key: its first number in this batch and the time before.
            if keys:
                heads = firsts.join(known, same_key(firsts, known)).select(
                    *[firsts[k].alias(f"_k_{k}") for k in keys],
                    firsts["_first"].alias("_head"),
                    known["_ts"].alias("_before"),
                )
            else:
                before = known.select("_ts").scalar()
                heads = firsts.select(F.col("_first").alias("_head"), before.alias("_before"))
            match = F.col(seq) == F.col("_head")
            for k in keys:
                match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
            joined = linked.join(heads, match, "left").withColumn(
                "prev_ts", F.coalesce("prev_ts", "_before")
            )
            joined.where(F.col(ts) < F.col("prev_ts")).select(
                *batch.columns, "prev_ts"
            ).write.mode("overwrite").parquet(batch_path(path, batch_id))
            latest = F.max_by(F.struct("_seq", "_ts"), "_seq").alias("last")
            kept = firsts.select(*carried.names)
            if batch_id % COMPACT == 0:
                kept = kept.unionByName(known)
                for old in range(max(0, base - COMPACT), base):
                    _remove(spark, batch_path(carry, old))
            else:
                # The batch's own keys: their newest row, old or new.
                kept = kept.unionByName(known.join(firsts, same_key(known, firsts), "left_semi"))
            kept.groupBy(*keys).agg(latest).where("last IS NOT NULL").select(*keys, "last.*").write.mode(
                "overwrite"
            ).parquet(batch_path(carry, batch_id))
        finally:
            batch.unpersist()

    return sink


def by_batches(
    stream: DataFrame,
    seq: str,
    ts: str,
    path: str,
    carry: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Run a stream, whose batches come in the order of ``seq``, into ``sink_into``."""
    sink = sink_into(stream.sparkSession, stream.schema, seq, ts, path, carry, keys, **options)
    return start(stream, sink, checkpoint, "append", trigger)


def by_reordered_batches(
    stream: DataFrame,
    seq: str,
    ts: str,
    delay: int,
    path: str,
    carry: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    dense: bool = False,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """As ``by_batches`` for a stream whose rows come up to ``delay`` numbers late, across batches
    too: they wait in ``carry`` for their turn. ``flush_reordered`` ends a bounded input."""
    sink = sink_into(stream.sparkSession, stream.schema, seq, ts, path, f"{carry}/last", keys, **options)
    return reorder.in_order(
        stream, seq, delay, lambda rows, n: sink(rows.drop("late"), n), f"{carry}/held", checkpoint, dense, trigger
    )


def flush_reordered(
    spark: SparkSession, schema: StructType, seq: str, ts: str, path: str, carry: str, batch_id: int, keys: Sequence[str] = (), **options
) -> None:
    """Compare the rows still held after the last batch ``batch_id - 1``."""
    sink = sink_into(spark, schema, seq, ts, path, f"{carry}/last", keys, **options)
    reorder.flush(spark, schema, seq, lambda rows, n: sink(rows.drop("late"), n), f"{carry}/held", batch_id)
