"""Shards under a byte limit by extendible hashing.

A row hashes to ``BITS`` bits of an MD5 digest over its key and its text's digest, so rows
that share a key still differ. The directory starts with one bucket, the empty prefix; a
bucket over the limit splits on its next bit, others stay: a row's shard is the shortest
prefix of its hash whose rows fit the limit. A bucket whose rows all have one hash cannot
split: a single row over the limit stays alone, and exact repeats of a row overflow into
numbered pages of as many rows as fit.

Sizes come from one aggregate over hash cells, a few bits finer than the expected depth;
the cells are summed up to every shorter prefix. Only cells still too large, if any, are
looked at with all bits. Texts are read once, for digest and length; what is kept and
shuffled is the key, the hash and the length.

A null key or text hashes as the text ``null``; a null text has 0 bytes. An empty table
gives no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.columns import prepared

BITS = 60
#: Bits by which hash cells are finer than the depth of equally full buckets.
FINER = 4


def row_hash(key: Column, text: Column) -> Column:
    """The leading ``BITS`` bits of the digest, as a whole number."""
    null = F.lit("null")
    both = F.concat_ws(":", F.coalesce(key.cast("string"), null), F.coalesce(F.md5(text.cast("binary")), null))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, BITS // 4), 16, 10).cast("bigint")


def _leaves(cells: DataFrame, shallow: int, deep: int, limit: int) -> DataFrame:
    """For each ``cell`` (a prefix of ``deep`` bits) the shortest prefix of at least
    ``shallow`` bits that fits or cannot split; null if even ``deep`` bits do not do."""
    spread = cells.withColumn("depth", F.explode(F.sequence(F.lit(shallow), F.lit(deep)))).withColumn(
        "bucket", F.expr(f"shiftright(cell, {deep} - depth)")
    )
    sums = spread.groupBy("depth", "bucket").agg(
        F.sum("size").alias("size"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    ends = sums.where((F.col("size") <= limit) | (F.col("low") == F.col("high"))).select("depth", "bucket")
    return (
        spread.select("cell", "depth", "bucket")
        .join(ends, ["depth", "bucket"])
        .groupBy("cell")
        .agg(F.min("depth").alias("depth"))
    )


def _cells(rows: DataFrame, bits: int) -> DataFrame:
    return rows.groupBy(F.shiftright("hash", BITS - bits).alias("cell")).agg(
        F.sum("size").alias("size"), F.min("hash").alias("low"), F.max("hash").alias("high")
    )


def assign_shards(docs: DataFrame, limit: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: ``key``, ``shard`` (prefix bits as text), ``depth``, ``page``, ``n_bytes``."""
    return _paged(_hashed(docs, limit, text, key), limit).select(
        F.col("_key").alias(key),
        _shard().alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        F.col("page"),
        F.col("size").alias("n_bytes"),
    )


def _shard() -> Column:
    """The ``depth`` leading bits of the hash as text."""
    bits = F.lpad(F.bin(F.expr(f"shiftright(hash, {BITS} - depth)")), F.col("depth"), F.lit("0"))
    return F.when(F.col("depth") == 0, F.lit("")).otherwise(bits)


def _hashed(docs: DataFrame, limit: int, text: str, key: str) -> DataFrame:
    """``_key``, ``hash``, ``size`` and the ``depth`` of its shard for every row."""
    prepared(docs.sparkSession)
    rows = docs.select(
        F.col(key).alias("_key"),
        row_hash(F.col(key), F.col(text)).alias("hash"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("size"),
    ).checkpoint()
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bits = min(BITS - 1, max(1, math.ceil(math.log2(max(1, total / limit)))) + FINER)
    coarse = _cells(rows, bits)
    known = _leaves(coarse, 0, bits, limit)
    placed = rows.withColumn("cell", F.shiftright("hash", BITS - bits)).join(known, "cell", "left")
    open_rows = placed.where("depth is null").select("_key", "hash", "size")
    finer = _leaves(_cells(open_rows, BITS), bits + 1, BITS, limit)
    rest = open_rows.withColumn("cell", F.col("hash")).join(finer, "cell", "left")
    return placed.where("depth is not null").unionByName(rest)


def _paged(found: DataFrame, limit: int) -> DataFrame:
    """Adds ``page``, which numbers the pages of exact repeats that overflow their bucket.

    Repeats are numbered per input partition first and shifted by the counts of earlier
    partitions, so that a row repeated very often is not numbered in one task.
    """
    one = found.groupBy("hash").agg(F.count("*").alias("n"), F.max("size").alias("each"))
    over = one.where((F.col("n") > 1) & (F.col("n") * F.col("each") > limit)).select("hash", "each")
    columns = found.columns
    marked = found.join(over, "hash", "left")
    whole = marked.where("each is null").select(*columns, F.lit(0).cast("bigint").alias("page"))
    many = marked.where("each is not null").withColumn("pos", F.monotonically_increasing_id()).checkpoint()
    many = many.withColumn("part", F.shiftright("pos", 33))
    before = Window.partitionBy("hash").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        many.groupBy("hash", "part")
        .agg(F.count("*").alias("rows"))
        .select("hash", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift"))
    )
    number = F.row_number().over(Window.partitionBy("hash", "part").orderBy("pos")) - 1 + F.col("shift")
    fits = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("each"), F.lit(1))))
    pages = many.join(shift, ["hash", "part"]).select(
        *columns, F.floor(number / fits).cast("bigint").alias("page")
    )
    return whole.unionByName(pages)


def write_shards(docs: DataFrame, limit: int, path: str, text: str = "text", key: str = "doc_id") -> None:
    """Write the rows as Parquet, one folder per shard and page (``shard=…/page=…``).

    A row's hash gives its shard; repeats are numbered among the rows that are written.
    """
    depths = _hashed(docs, limit, text, key).select("hash", "depth").distinct()
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"),
        row_hash(F.col(key), F.col(text)).alias("hash"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("size"),
    )
    paged = _paged(rows.join(depths, "hash"), limit)
    paged.select("_row.*", _shard().alias("shard"), "page").withColumn("shard", F.concat(F.lit("b"), "shard")).repartition("shard", "page").write.partitionBy(
        "shard", "page"
    ).parquet(path)
