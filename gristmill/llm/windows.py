"""MinHash signatures of overlapping text windows, in DataFrame operations only.

Shingle hashes of a text are cut into blocks of ``base`` shingles; a block's signature is
the least of ``HASHES`` hash functions over its shingles. A window of class ``c`` is
``2 · base · 2^c`` shingles long and starts every ``base · 2^c`` shingles, so any stretch of
up to ``base · 2^c`` shingles lies in one window whole. Window signatures are the minima
of their blocks' signatures, so every shingle is hashed once, whatever the classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.columns import with_shingles

HASHES = 64


def minima(hash_: Column) -> list[Column]:
    """One aggregate per hash function."""
    return [F.min(F.xxhash64(F.lit(i), hash_)).alias(f"m{i}") for i in range(HASHES)]


NAMES = [f"m{i}" for i in range(HASHES)]


#: The columns that identify a text: the key as text, a hash of the text, and the key itself.
KEYS = ["_id", "_mark", "_key"]


def dealt_texts(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``KEYS`` and ``_text``, dealt out by id and mark.

    Windows are grouped and candidates are joined on this partitioning, and all users of
    the result take the same columns, so Spark shuffles the texts once and reads that
    shuffle again for the verification.
    """
    return docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("_id"),
        F.xxhash64(text).alias("_mark"),
        F.col(key).alias("_key"),
        F.col(text).alias("_text"),
    ).repartition("_id", "_mark")


def candidate_texts(dealt: DataFrame, found: DataFrame, what: str) -> DataFrame:
    """The texts of the candidates ``KEYS`` and ``what``, with all their ``what`` as an array."""
    wanted = found.groupBy("_id", "_mark").agg(F.collect_set(what).alias("_all"))
    names = {"_id": "_i", "_mark": "_m"}
    wanted = wanted.withColumnsRenamed(names)
    same = (F.col("_id") == F.col("_i")) & (F.col("_mark") == F.col("_m"))
    return dealt.join(wanted.hint("shuffle_hash"), same).select(*KEYS, "_text", "_all")


def window_signatures(dealt: DataFrame, width: int, base: int, classes: list[int]) -> DataFrame:
    """``KEYS``, ``class``, ``window`` and the minima of every window that has a shingle, of
    ``dealt_texts``; the grouping keeps their partitioning."""
    keys = KEYS
    grams = with_shingles(dealt, "_text", width)
    # The outer form: for the plain one Catalyst adds a filter on the array's size, which it
    # pushes below the column of word hashes, and the text is then split once per shingle.
    rows = grams.select(*keys, F.posexplode_outer("shingles").alias("pos", "h")).where("pos is not null")
    blocks = rows.groupBy(*keys, F.expr(f"pos div {base}").alias("block")).agg(*minima(F.col("h")))
    windows = [
        F.struct(F.lit(c).alias("class"), F.expr(f"shiftright(block, {c}) - {back}").alias("window"))
        for c in classes
        for back in (0, 1)
    ]
    spread = blocks.select(*keys, F.explode(F.array(*windows)).alias("at"), *NAMES).select(
        *keys, "at.class", "at.window", *NAMES
    )
    # Window -1 holds the first block only, which window 0 holds too.
    return (
        spread.where("window >= 0 ")
        .groupBy(*keys, "class", "window")
        .agg(*[F.min(n).alias(n) for n in NAMES])
    )


def set_signatures(items: DataFrame, keys: list[str], shingles: str) -> DataFrame:
    """``keys`` and the minima of whole shingle sets."""
    rows = items.select(*keys, F.explode_outer(shingles).alias("h")).where("h is not null")
    return rows.groupBy(*keys).agg(*minima(F.col("h")))


def signature_values(signed: DataFrame, keys: list[str]) -> DataFrame:
    """One row per signature value; equal values of two sets come from the same function."""
    return signed.select(*keys, F.explode(F.array_distinct(F.array(*NAMES))).alias("value"))
