"""Splits of exact sizes: the same rows for any partitioning, ties, nulls, repeats, empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gristmill.operators import splits


@pytest.mark.parametrize("n", [0, 1, 2, 5, 10, 997])
def test_sizes_are_exact_and_rows_the_same_for_any_partitioning(spark, n):
    got = []
    for parts in (1, 3, 8):
        df = spark.range(n).withColumn("v", F.col("id") * 2).repartition(parts)
        first, second = splits.exact_split(df, "id")
        a, b = ({tuple(r) for r in x.collect()} for x in (first, second))
        assert len(a) == int(n * 0.9 + 0.5) and len(a) + len(b) == n and not a & b
        got.append(a)
    assert got[0] == got[1] == got[2]


def test_the_smallest_digests_are_taken(spark):
    df = spark.range(500)
    first, second = splits.exact_split(df, "id", share=0.3)
    order = [r["id"] for r in df.orderBy(splits.digest("id")).collect()]
    assert {r["id"] for r in first.collect()} == set(order[:150])
    assert {r["id"] for r in second.collect()} == set(order[150:])


def test_repeated_and_null_keys_are_split_to_the_row(spark):
    rows = [(7, i % 4) for i in range(40)] + [(None, i % 3) for i in range(20)]
    df = spark.createDataFrame(rows, "k int, v int")
    for share in (0.1, 0.5, 0.9, 1.0):
        first, second = splits.exact_split(df.repartition(4), "k", share=share)
        assert first.count() == int(60 * share + 0.5)
        whole = sorted(str(tuple(r)) for x in (first, second) for r in x.collect())
        assert whole == sorted(map(str, rows))


def test_seeds_differ(spark):
    df = spark.range(200)
    one, two = ({r["id"] for r in splits.exact_split(df, "id", seed=s)[1].collect()} for s in (1, 2))
    assert one != two and len(one) == len(two) == 20
