"""Aggregates per key over delimited records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def readings(lines: DataFrame, value: str = "value") -> DataFrame:
    """``station,date,entry,tenths`` lines to station, entry, degrees."""
    field = F.split(value, ",")
    return lines.select(
        F.get(field, F.lit(0)).alias("station"),
        F.get(field, F.lit(2)).alias("entry"),
        (F.get(field, F.lit(3)).try_cast("double") * 0.1).alias("degrees"),
    )


def extreme_by_station(records: DataFrame, entry: str, largest: bool = True) -> DataFrame:
    """Largest or smallest reading per station among entries containing a mark."""
    pick = F.max if largest else F.min
    return (
        records.where(F.col("entry").contains(entry))
        .groupBy("station")
        .agg(pick("degrees").alias("degrees"))
    )


def degree_lines(extremes: DataFrame) -> DataFrame:
    """``station<TAB>12.34C`` lines."""
    return extremes.select(
        F.format_string("%s\t%.2fC", "station", "degrees").alias("line")
    )


def order_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``customer,item,amount`` lines to typed columns."""
    field = F.split(value, ",")
    return lines.select(
        F.get(field, F.lit(0)).alias("customer_id"),
        F.get(field, F.lit(1)).alias("item_id"),
        F.get(field, F.lit(2)).try_cast("double").alias("amount"),
    )


def total_by(df: DataFrame, key: str, amount: str, name: str = "total_spent") -> DataFrame:
    """Sum per key, rounded to 2 places: double sums depend on their order."""
    return df.groupBy(key).agg(F.round(F.sum(amount), 2).alias(name))


def average_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Average per key, largest first."""
    return (
        df.groupBy(key)
        .agg(F.avg(value).alias(name))
        .orderBy(F.col(name).desc_nulls_last(), key)
    )


def rating_histogram(lines: DataFrame, value: str = "value", field: int = 2) -> DataFrame:
    """Count the values of one white-space separated field, in key order."""
    return (
        lines.select(F.get(F.split(value, r"\s+"), F.lit(field)).alias("rating"))
        .groupBy("rating")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("rating")
    )


def most_hyped(
    ratings: DataFrame, movies: DataFrame, best: int = 5, at_least: int = 5, k: int = 10
) -> DataFrame:
    """Titles with the highest share of top ratings.

    Ratings shrink to one row per movie before the join, so a hot movie never
    meets its title row by row; titles shared by several movies merge after it.
    """
    per_movie = ratings.groupBy("movie_id").agg(
        F.count(F.when(F.col("rating") == best, 1)).alias("fives"),
        F.count(F.lit(1)).alias("total"),
    )
    return (
        per_movie.join(movies, "movie_id")
        .groupBy("title")
        .agg(
            F.sum("fives").alias("five_star_count"),
            F.sum("total").alias("total_count"),
        )
        .where(F.col("total_count") >= at_least)
        .withColumn(
            "ratio",
            F.col("five_star_count").cast("double") / F.col("total_count").cast("double"),
        )
        .orderBy(F.col("ratio").desc(), "title")
        .limit(k)
    )
