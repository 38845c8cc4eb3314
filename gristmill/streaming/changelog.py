"""One update per input: the running count of a key after each of its rows.

The rows of a batch are cut into blocks, stretches of their order between bounds that are taken
from a sample. The count after a row is the number of rows of its key up to it in its block, plus
those in earlier blocks of the batch, plus those of earlier batches. A window holds one key of
one block, so a very common key is split; what came before a block is one row per key and block,
which enters the window ahead of its rows. The rows are shuffled and sorted once.

Rows count in the order of the batches and, inside a batch, in the order of the given
columns. A null key is a key. An empty batch changes nothing. A batch is read three times and must
be the same each time, as from any source that can replay.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from gristmill.session import shared_dir
from gristmill.streaming import slots
from gristmill.streaming.runs import batch_path, start

#: About how many rows make a block.
BLOCK_ROWS = 1_000_000
#: Rows drawn to find the bounds of blocks, and how many of them each block has at least.
DRAWN, DRAWN_A_BLOCK = 8192, 8


def with_block(rows: DataFrame, order: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``_block`` from 0: rows of a later block come later in the order of ``order``. Equal rows
    share a block. The bounds are fixed numbers of the plan, so every use sees the same blocks."""
    draws = rows.select(*order, F.rand(42).alias("_draw")).orderBy("_draw").limit(DRAWN)
    drawn = draws.orderBy(*order).collect()
    # Draws are even between 0 and 1: the last of the smallest tells how many there are in all.
    total = len(drawn) if len(drawn) < DRAWN else DRAWN / max(r["_draw"] for r in drawn)
    blocks = min(math.ceil(total / block_rows), max(1, len(drawn) // DRAWN_A_BLOCK if total > len(drawn) else len(drawn)))
    if blocks < 2:
        return rows.withColumn("_block", F.lit(0))
    bounds = rows.sparkSession.createDataFrame([drawn[len(drawn) * i // blocks] for i in range(1, blocks)], draws.schema)
    listed = bounds.agg(F.sort_array(F.collect_list(F.struct(*order)))).scalar()
    found = rows.withColumn("_bounds", listed).withColumn("_place", F.struct(*order)).withColumn("_block", F.lit(0))
    # Binary search: how many bounds are not above the row; there is no bound past the last.
    for step in (1 << k for k in reversed(range((blocks - 1).bit_length()))):
        below = F.get("_bounds", F.col("_block") + (step - 1)) <= F.col("_place")
        found = found.withColumn("_block", F.col("_block") + F.when(below, step).otherwise(0))
    return found.drop("_bounds", "_place")


def running_counts(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], carried: DataFrame, name: str = "n", block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the running count of their key, and the counts to carry on (``keys``, ``_total``)."""
    keys = list(keys)
    shared_dir(rows.sparkSession)
    blocked = with_block(rows, order, block_rows)
    counts = blocked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_rows")).checkpoint()
    known = carried.select(*keys, F.lit(-1).alias("_block"), F.col("_total").alias("_rows"))
    both = counts.unionByName(known)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = both.withColumn("_step", F.sum("_rows").over(earlier)).where("_block >= 0 and _step is not null")
    heads = before.drop("_rows").withColumn("_row", F.lit(0))
    steps = blocked.withColumns({"_step": F.lit(1).cast("long"), "_row": F.lit(1)})
    inside = Window.partitionBy(*keys, "_block").orderBy("_row", *order)
    so_far = F.sum("_step").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = steps.unionByName(heads, allowMissingColumns=True).withColumn("_so_far", so_far).where("_row = 1")
    out = counted.select(*rows.columns, F.col("_so_far").alias(name))
    return out, both.groupBy(*keys).agg(F.sum("_rows").alias("_total"))


def by_batches(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    path: str,
    carry: str,
    checkpoint: str,
    name: str = "n",
    trigger: dict | None = None,
    block_rows: int = BLOCK_ROWS,
) -> StreamingQuery:
    """Write every row with the running count of its key below ``path``, one folder per batch;
    ``carry`` holds the count per key after the last two batches."""
    spark, keys = stream.sparkSession, list(keys)
    types = {f.name: f.dataType for f in stream.schema.fields}
    carried = StructType([StructField(k, types[k]) for k in keys]).add("_total", "long")

    def sink(batch: DataFrame, batch_id: int) -> None:
        known = slots.before(spark, carry, batch_id, carried)
        changes, total = running_counts(batch, keys, order, known, name, block_rows)
        changes.write.mode("overwrite").parquet(batch_path(path, batch_id))
        slots.leave(total, carry, batch_id)

    return start(stream, sink, checkpoint, "append", trigger)
