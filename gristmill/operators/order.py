"""Row order on a distributed table: dense positions and previous-row values
without a window that holds the whole table or a whole hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.session import shared_dir

#: Rows that are compared in one window.
BUCKET_ROWS = 1_000_000


def with_position(
    df: DataFrame, order: Sequence[str], name: str = "pos"
) -> DataFrame:
    """Add the 1-based rank of each row in the total order of ``order``.

    One range sort; each sorted partition numbers its own rows, and the sizes of
    the partitions before it (one row per partition) give the offset. The sorted
    rows are checkpointed, since both uses must see the same partitions.
    """
    shared_dir(df.sparkSession)
    step = 1 << 33  # monotonically_increasing_id: partition in the upper bits
    ranked = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.expr(f"_id div {step}"))
        .withColumn("_row", F.col("_id") % step)
        .drop("_id")
        .checkpoint()
    )
    sizes = ranked.groupBy("_part").agg((F.max("_row") + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    # One row per partition of the sort, so the broadcast is bounded.
    return (
        ranked.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row") + 1)
        .drop("_part", "_row", "_offset")
    )


def with_previous(
    df: DataFrame,
    value: str,
    seq: str,
    keys: Sequence[str] = (),
    name: str = "prev",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``value`` of the row before with the same keys, in the order of ``seq``.

    The rows are numbered in the order of keys and ``seq``; buckets of ``bucket_rows``
    positions are windows, whatever the keys and however sparse ``seq`` is. The first row
    of a bucket looks at the last row of the bucket before, from a table with one row per
    bucket. Rows without ``seq`` come first; null is a key too.
    """
    keys = list(keys)
    numbered = with_position(df, [*keys, seq], "_pos").withColumn(
        "_bucket", F.expr(f"(_pos - 1) div {bucket_rows}")
    )
    own = F.struct(F.struct(*keys).alias("k") if keys else F.lit(0).alias("k"), F.col(value).alias("v"))
    inside = Window.partitionBy("_bucket").orderBy("_pos")
    rows = numbered.withColumn("_own", own).withColumn("_before", F.lag("_own").over(inside))
    tails = numbered.groupBy(F.col("_bucket") + 1).agg(F.max_by(own, "_pos").alias("_tail"))
    linked = rows.join(tails.toDF("_bucket", "_tail"), "_bucket", "left").withColumn(
        "_link", F.coalesce("_before", "_tail")
    )
    same = F.col("_link.k").eqNullSafe(F.col("_own.k"))
    return linked.withColumn(name, F.when(same, F.col("_link.v"))).select(*df.columns, name)


def out_of_order(
    df: DataFrame, ts: str, seq: str, keys: Sequence[str] = (), **kwargs
) -> DataFrame:
    """Rows whose time lies before that of the row ahead of them."""
    linked = with_previous(df, ts, seq, keys, name="prev_ts", **kwargs)
    return linked.where(F.col("prev_ts").isNotNull() & (F.col(ts) < F.col("prev_ts")))
