from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import models, splits, tables, words


def rows(df):
    return [tuple(r) for r in df.collect()]


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_readings_by_station(spark):
    data = tables.readings(
        lines(spark, "A,1800,TMAX,-75,,", "A,1800,TMAX,100", "A,1800,TMIN,-148", "B,1800,XTMAXX,5", "B,1800", "C,1800,TMAX,bad")
    )
    hot = tables.extreme_by_station(data, "TMAX")
    assert dict(rows(hot)) == {"A": 10.0, "B": 0.5, "C": None}
    assert dict(rows(tables.extreme_by_station(data, "TMIN", largest=False))) == {"A": -148 * 0.1}
    assert "A\t10.00C" in [r[0] for r in tables.degree_lines(hot).collect()]


def test_spend(spark):
    orders = tables.order_lines(lines(spark, "1,10,0.1", "1,11,0.2", "2,10,5", "3,1,5", "4,1,oops"))
    totals = tables.total_by(orders, "customer_id", "amount")
    assert rows(words.top(totals, 3, "customer_id", by="total_spent")) == [("2", 5.0), ("3", 5.0), ("1", 0.3)]


def test_average_by(spark):
    people = spark.createDataFrame([(30, 1), (30, 2), (20, 9), (40, None)], "age int, friends int")
    got = tables.average_by(people, "age", "friends", "average")
    assert rows(got) == [(20, 9.0), (30, 1.5), (40, None)]


def test_rating_histogram(spark):
    got = tables.rating_histogram(lines(spark, "1\t2\t5\t9", "1 2  3 9", "1\t2\t5\t9"))
    assert rows(got) == [("3", 1), ("5", 2)]


def test_most_hyped_merges_titles_and_drops_unknown_movies(spark):
    movies = spark.createDataFrame([(1, "Same"), (2, "Same"), (3, "Few"), (4, "All")], "movie_id int, title string")
    votes = [(1, 5)] * 2 + [(1, 4)] + [(2, 1)] * 2 + [(3, 5)] * 4 + [(4, 5)] * 5 + [(9, 5)] * 9
    ratings = spark.createDataFrame(votes, "movie_id int, rating int")
    for parts in (1, 4, 17):
        got = rows(tables.most_hyped(ratings.repartition(parts), movies))
        assert got == [("All", 5, 5, 1.0), ("Same", 2, 5, 0.4)]


def flights(spark, *pairs):
    """(cancelled, delay) rows; the rest is fixed."""
    data = [
        (2002, 1, i % 28 + 1, 1, 900, 1000, "AB"[i % 2], "60" if i % 3 else "NA", "X", "Y", 100 + i, c, d)
        for i, (c, d) in enumerate(pairs)
    ]
    types = ["int"] * 6 + ["string", "string", "string", "string", "int", "int", "string"]
    schema = ", ".join(f"{n} {t}" for n, t in zip(models.FLIGHT_COLUMNS, types))
    return spark.createDataFrame(data, schema)


def test_delay_rows_read_text_leniently(spark):
    got = models.delay_rows(flights(spark, (0, "NA"), (0, ""), (0, None), (0, "5"), (1, "5"), (0, "0")))
    assert [(r["label"], r["CRSElapsedTime"]) for r in got.collect()] == [(1.0, None), (0.0, 60)]


def test_string_index_orders_by_frequency_then_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "UniqueCarrier string")
    indexed = models.index_strings(df, ["UniqueCarrier"]).transform(df).distinct()
    assert dict(rows(indexed)) == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_delay_models_learn_and_skip_unseen_values(spark):
    data = models.delay_rows(flights(spark, *[(0, str(10 if i >= 60 else -10)) for i in range(120)]))
    unseen = data.limit(1).withColumn("Origin", F.lit("Z"))
    for fit in (models.delay_logistic, models.delay_forest):
        got = models.accuracy(fit(data, data.unionByName(unseen))).first()
        assert got["accuracy"] > 0.9
        assert got["n"] == 80  # rows without a flight time are skipped, and so is Z
    chosen = models.delay_model(data, data, gate=1.1).select("model").distinct()
    assert rows(chosen) == [("forest",)]


def test_price_tree_and_error(spark):
    df = spark.createDataFrame([(float(i), 2.0, 3, float(i // 10)) for i in range(40)], "a double, b double, c int, price double")
    got = models.price_tree(df, df, ["a", "b", "c"], "price")
    assert models.mean_abs_error(got, "price").first()[0] == 0.0
    fixed = spark.createDataFrame([(1.0, 2.0), (5.0, 2.0)], "prediction double, price double")
    assert rows(models.mean_abs_error(fixed, "price")) == [(2.0,)]


def test_union_and_random_splits(spark):
    df = spark.range(1000)
    assert splits.union_all(df, df.selectExpr("id + 1 AS x")).count() == 2000
    a, b = splits.random_split(df)
    assert a.count() + b.count() == 1000 and 50 < b.count() < 150
    train, test = splits.hash_split(df.repartition(3), "id")
    again = splits.hash_split(df.repartition(7), "id")[1]
    assert sorted(rows(test)) == sorted(rows(again))
    assert train.intersect(test).count() == 0 and train.count() + test.count() == 1000
    drawn = {splits.random_row(df.repartition(n), "id", 1).first()[0] for n in (1, 3, 8)}
    assert len(drawn) == 1
