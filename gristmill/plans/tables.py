"""Aggregates over readings, spend, ratings."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import order, tables, words
from gristmill.plans import bindings as b
from gristmill.plans.registry import query


def station_sql(pick: str, entry: str) -> str:
    return f"""
    SELECT CAST(user_id AS VARCHAR) AS station, {pick}(value * 0.1) AS degrees
    FROM events WHERE contains(upper(event_type), '{entry}') GROUP BY 1"""


@query(station_sql("max", "PURCHASE"))
def max_by_station(spark, folder):
    readings = tables.readings(b.reading_lines(spark, folder))
    return tables.extreme_by_station(readings, "PURCHASE")


@query(station_sql("min", "VIEW"))
def min_by_station(spark, folder):
    readings = tables.readings(b.reading_lines(spark, folder))
    return tables.extreme_by_station(readings, "VIEW", largest=False)


SPENT = f"SELECT customer_id, round(sum(amount), 2) AS total_spent FROM ({b.SPEND_SQL}) GROUP BY 1"


@query(f"{SPENT} ORDER BY total_spent DESC, customer_id LIMIT 20")
def top_spenders(spark, folder):
    totals = tables.total_by(b.spend(spark, folder), "customer_id", "amount")
    return words.top(totals, 20, "customer_id", by="total_spent")


@query(f"{SPENT} ORDER BY total_spent DESC")
def total_spent(spark, folder):
    totals = tables.total_by(b.spend(spark, folder), "customer_id", "amount")
    return totals.orderBy(F.col("total_spent").desc(), "customer_id")


@query("""
SELECT c_nationkey AS age, avg(CAST(floor(c_acctbal) AS BIGINT)) AS average_friends
FROM customer GROUP BY 1 ORDER BY 2 DESC, 1""")
def avg_by_group(spark, folder):
    return tables.average_by(b.friends(spark, folder), "age", "friends", "average_friends")


@query("""
SELECT CAST(CAST(l_quantity AS INTEGER) % 5 + 1 AS VARCHAR) AS rating, count(*) AS n
FROM lineitem GROUP BY 1 ORDER BY 1""")
def rating_histogram(spark, folder):
    return tables.rating_histogram(b.rating_lines(spark, folder))


@query(f"""
SELECT title, five_star_count, total_count,
       CAST(five_star_count AS DOUBLE) / CAST(total_count AS DOUBLE) AS ratio
FROM (
    SELECT m.p_name AS title, count(CASE WHEN r.rating = 5 THEN 1 END) AS five_star_count,
           count(*) AS total_count
    FROM ({b.VOTES_SQL}) r JOIN part m ON r.movie_id = m.p_partkey
    GROUP BY m.p_name HAVING count(*) >= 5)
ORDER BY ratio DESC, title LIMIT 10""")
def most_hyped(spark, folder):
    """Named views over the sources, then the report."""
    b.votes(spark, folder).createOrReplaceTempView("ratings")
    b.movies(spark, folder).createOrReplaceTempView("movies")
    return tables.most_hyped(
        spark.sql("SELECT movie_id, rating FROM ratings"),
        spark.sql("SELECT movie_id, title FROM movies"),
    )


LATE = """
SELECT o_orderkey, o_custkey, o_orderdate, prev_ts FROM (
    SELECT *, lag(o_orderdate) OVER ({window}) AS prev_ts FROM orders)
WHERE o_orderdate < prev_ts"""
GLOBAL_LATE = LATE.format(window="ORDER BY o_orderkey")
KEYED_LATE = LATE.format(window="PARTITION BY o_custkey ORDER BY o_orderkey")


def order_records(spark, folder):
    return b.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")


@query(GLOBAL_LATE)
def out_of_order(spark, folder):
    return order.out_of_order(order_records(spark, folder), "o_orderdate", "o_orderkey")


@query(KEYED_LATE)
def out_of_order_keyed(spark, folder):
    return order.out_of_order(
        order_records(spark, folder), "o_orderdate", "o_orderkey", ["o_custkey"]
    )
