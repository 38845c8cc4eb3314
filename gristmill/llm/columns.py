"""Expressions and session helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.session import shared_dir, tune

#: Rows and bytes of one Arrow batch: a worker holds a few such batches at a time.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The session with small Arrow batches and a checkpoint folder."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    shared_dir(spark)
    return spark


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null stays null."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def lower_words(text: Column) -> Column:
    """Lower-case runs of letters and digits; a null text has none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda word: word != "")


def with_shingles(df: DataFrame, text: str, width: int, out: str = "shingles") -> DataFrame:
    """Replace ``text`` by the array of 64-bit hashes of ``width`` adjacent words, in order.

    A text with fewer words has an empty array. Words are hashed once each; the array of
    word hashes is named several times below, so Catalyst keeps it as a column.
    """
    others = [c for c in df.columns if c != text]
    hashed = df.select(*others, F.transform(lower_words(F.col(text)), lambda w: F.xxhash64(w)).alias("_wh"))
    words = F.col("_wh")
    last = F.size(words) - width
    joined = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]),
    )
    empty = F.array().cast("array<bigint>")
    return hashed.select(*others, F.when(last >= 0, joined).otherwise(empty).alias(out))


def map_arrow(
    df: DataFrame, schema: str, rows: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]]
) -> DataFrame:
    """``mapInArrow`` over dictionaries of Python lists, one per batch."""

    fields = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in rows(batch.to_pydict() for batch in batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[f.name], f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, fields)
