"""Benchmark items inside documents: size-partitioned MinHash containment search.

Items and documents become hashed shingles of five words. Items are partitioned by the
number of their shingles; partition ``c`` holds those with up to ``BASE · 2^c`` (and more
than half of that, so more than ``SHORT``). For every partition the documents are cut into
windows of twice the partition's size (see ``windows``). A window that shares one of 64
MinHash values with an item of its partition is a candidate. One that holds a whole item has
a Jaccard similarity of a quarter or more with it, however long the document, and is missed
with a chance of 1e-8; one that holds 80 % of it has 0.19 or more, with a chance of 1.4e-6.

Items of up to ``SHORT`` shingles are too small for a window: they are found exactly, by
the shingles themselves. A document that holds an item up to the threshold lacks few of its
shingles, so it has one of any few more than those; the ones that the fewest items share are
looked up.

Every candidate document is then verified exactly: the share of the item's distinct
shingles that the document holds must be ``THRESHOLD`` or more. All of this is DataFrame
operations; texts are shuffled once by document, windows not at all. More short items than
may be broadcast cost a shuffle of the documents' shingles.

Items with fewer than five words have no shingle and are never found; the same holds for
such documents, and for null and empty texts. Repeated documents give repeated rows. An item
is its id and its text: repeats of both count once, two texts of one id are two items and
give a row each, and items without an id are found like others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.columns import prepared, with_shingles
from gristmill.llm.windows import (
    KEYS,
    candidate_texts,
    dealt_texts,
    set_signatures,
    signature_values,
    window_signatures,
)

WIDTH, THRESHOLD, BASE = 5, 0.8, 32
#: Shingles of an item up to which it is looked up exactly; half of ``BASE``.
SHORT = BASE // 2
#: Bytes of benchmark signatures that may be sent to every task; larger ones are shuffled.
BROADCAST_BYTES = 32 << 20


def partition_of(size: Column, base: int = BASE) -> Column:
    """The least c with size ≤ base · 2^c."""
    return F.greatest(F.lit(0), F.ceil(F.log2(size / base))).cast("int")


def _probes(short: DataFrame, threshold: float) -> DataFrame:
    """``h`` and ``ref``: of each item so many shingles that a document at the threshold has
    one of them, those that the fewest items have."""
    lacking = F.floor(F.size("held") * (1 - threshold) + 1e-9)
    each = short.select("ref", lacking.alias("lacking"), F.explode("held").alias("h"))
    shared = each.groupBy("h").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("ref").orderBy("n", "h")
    ranked = each.join(shared, "h").withColumn("rank", F.row_number().over(rarest))
    return ranked.where(F.col("rank") <= F.col("lacking") + 1).select("h", "ref")


def find_items(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``key``, ``item``, ``containment`` for every document and item at the threshold or above."""
    found = _held_items(docs, items, text, key, item_text, item_key, threshold)
    return found.select(F.col("_key").alias(key), "item", "containment")


def _held_items(
    docs: DataFrame,
    items: DataFrame,
    text: str,
    key: str,
    item_text: str = "text",
    item_key: str = "item_id",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``find_items`` with the ``KEYS`` of the document."""
    prepared(docs.sparkSession)
    named = items.select(F.col(item_key).alias("item"), F.col(item_text).cast("string").alias("_t"))
    # The id as text, marked, so that no id equals a missing one.
    known = F.when(F.col("item").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("item").cast("string")))
    named = named.withColumn("ref", F.xxhash64(known, "_t"))
    tests = (
        with_shingles(named, "_t", WIDTH, "held")
        .select("ref", "item", F.array_distinct("held").alias("held"))
        .dropDuplicates(["ref"])
        .checkpoint()
        .where(F.size("held") > 0)
        .withColumn("class", partition_of(F.size("held")))
    )
    # Partitions grow by powers of two, so there are few of them.
    is_short = F.size("held") <= SHORT
    facts = tests.groupBy("class", is_short.alias("short")).agg(
        F.count("*").alias("count"), F.sum(F.size("held")).alias("size")
    ).collect()
    classes = sorted({row["class"] for row in facts if not row["short"]})
    if not facts:
        nothing = F.lit(None).cast(items.schema[item_key].dataType).alias("item")
        return dealt_texts(docs.where("false"), text, key).select(*KEYS, nothing, F.lit(0.0).alias("containment"))
    dealt = dealt_texts(docs, text, key)
    # Bytes of the signatures, and of the shingles that the verification sends.
    small = sum(64 * 64 * row["count"] + 16 * row["size"] for row in facts) <= BROADCAST_BYTES
    ways = []
    if classes:
        values = signature_values(set_signatures(tests.where(~is_short), ["ref", "class"], "held"), ["ref", "class"])
        values = F.broadcast(values) if small else values
        windows = signature_values(window_signatures(dealt, WIDTH, BASE, classes), [*KEYS, "class"])
        ways.append(windows.join(values, ["class", "value"]).select(*KEYS, "ref"))
    if any(row["short"] for row in facts):
        probes = _probes(tests.where(is_short), threshold)
        probes = F.broadcast(probes) if small else probes
        grams = with_shingles(dealt, "_text", WIDTH).select(*KEYS, F.explode_outer("shingles").alias("h"))
        ways.append(grams.join(probes, "h").select(*KEYS, "ref"))
    candidates = reduce(DataFrame.unionByName, ways)
    asked = candidate_texts(dealt, candidates, "ref")
    spoken = with_shingles(asked, "_text", WIDTH, "has").select(*KEYS, F.array_distinct("has").alias("has"), "_all")
    pairs = spoken.select(*KEYS, "has", F.explode_outer("_all").alias("ref"))
    held = tests.select("ref", "item", "held")
    both = pairs.join(F.broadcast(held) if small else held, "ref")
    share = F.size(F.array_intersect("held", "has")) / F.size("held")
    return both.select(*KEYS, "item", share.alias("containment")).where(F.col("containment") >= threshold)


def without_items(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents, all columns, that hold no item.

    A document is its id and its text: other texts of the same id, or without one, stay.
    """
    found = _held_items(docs, items, text, key).select(F.col("_id").alias("__id"), F.col("_mark").alias("__mark"))
    same = (F.coalesce(docs[key].cast("string"), F.lit("null")) == F.col("__id")) & (
        F.xxhash64(docs[text]) == F.col("__mark")
    )
    return docs.join(found.distinct(), same, "left_anti")
