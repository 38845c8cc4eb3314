from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gristmill.operators import order, splits


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_position_is_the_rank(spark, parts):
    # One third of the rows share the leading key.
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 37 % 1000).alias("k"), "id"
    )
    got = rows(order.with_position(df.repartition(parts), ["k", "id"]).select("k", "id", "pos"))
    assert [r[:2] for r in sorted(got, key=lambda r: r[2])] == sorted(rows(df))
    assert sorted(r[2] for r in got) == list(range(1, 3001))


def test_position_of_nothing(spark):
    assert order.with_position(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("size", [1, 7, 1_000_000])
def test_previous_equals_plain_lag(spark, keys, size):
    df = spark.range(400).select(
        (F.col("id") * 3 - 50).alias("seq"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 5).alias("k"),
        F.when(F.col("id") % 11 != 0, F.hash("id") % 100).alias("v"),
    )
    plain = df.withColumn("prev", F.lag("v").over(Window.partitionBy(*keys).orderBy("seq")))
    for parts in (1, 5):
        got = order.with_previous(df.repartition(parts), "v", "seq", keys, bucket_rows=size)
        assert sorted(rows(got), key=str) == sorted(rows(plain), key=str)


def test_out_of_order(spark):
    df = spark.createDataFrame([(1, 10), (2, 9), (3, None), (4, 8), (5, 8), (6, 3)], "seq long, ts int")
    assert sorted(rows(order.out_of_order(df, "ts", "seq"))) == [(2, 9, 10), (6, 3, 8)]


def test_k_folds(spark):
    df = spark.range(23).withColumnRenamed("id", "r").repartition(4)
    folds = splits.k_folds(df, ["r"])
    assert [r["fold"] for r in folds.orderBy("r").collect()] == [i // 5 + 1 for i in range(23)]
    base, test = splits.fold(folds, 2)
    assert sorted(r["r"] for r in test.collect()) == [5, 6, 7, 8, 9]
    assert base.count() == 18
    fixed = splits.k_folds(df, ["r"], k=2, size=4)
    assert [r["fold"] for r in fixed.orderBy("r").collect()] == [1] * 4 + [2] * 4 + [0] * 15


RATINGS = [(1, "a"), (2, "a"), (1, "b"), (1, "c"), (2, "b"), (3, "a"), (1, "d"), (2, "c")]


def brute(start, stop, cap):
    seen, test = {}, []
    for i, (user, _) in enumerate(RATINGS):
        seen[user] = seen.get(user, 0) + 1
        if (cap <= 0 or len(test) < cap) and start <= seen[user] <= stop:
            test.append(i)
    return test


@pytest.mark.parametrize("bounds", [(1, 2, 0), (2, 3, 0), (2, 3, 2), (1, 10, 100), (4, 9, 1), (1, 1, 1), (9, 9, 3)])
def test_leave_n_equals_the_sequential_rule(spark, bounds):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(RATINGS)], "p int, user int, item string")
    for parts in (1, 4):
        got = splits.leave_n(df.repartition(parts), "user", ["p"], *bounds)
        assert sorted(r["p"] for r in got.where("is_test").collect()) == brute(*bounds)
        assert got.count() == len(RATINGS)


def test_leave_n_beyond_a_block(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("u"))
    for size in (64, 1_000_000):
        got = splits.leave_n(df, "u", ["id"], 1500, 2000, block_rows=size).where("is_test")
        want = [i for i in range(5000) if i % 10][1499:2000]
        assert sorted(r["id"] for r in got.collect()) == want


def test_sparse_numbers_need_few_buckets(spark):
    df = spark.range(1000).select((F.col("id") * 10**9).alias("seq"), F.hash("id").alias("v"))
    got = order.with_previous(df, "v", "seq", bucket_rows=100)
    plain = df.withColumn("prev", F.lag("v").over(Window.orderBy("seq")))
    assert sorted(rows(got)) == sorted(rows(plain), key=lambda r: r[0])
