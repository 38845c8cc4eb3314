"""Equal-width histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """``bin, low, high, n`` over min..max; half-open bins, the last one closed.

    The range is one row, read as a scalar subquery. A single distinct value
    widens the range by half a unit on both sides. Bins without rows are kept.
    """
    # One row per value: the range and the bins both work on the counts.
    values = (
        df.groupBy(F.col(value).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("x").isNotNull())
    )
    ends = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    limits = ends.select(F.struct("lo", "hi")).scalar()

    def edge(i):
        return F.when(i == bins, F.col("hi")).otherwise(
            i * ((F.col("hi") - F.col("lo")) / bins) + F.col("lo")
        )

    # The division only guesses the bin; the edges decide.
    guess = F.least(
        F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins),
        F.lit(bins - 1),
    )
    placed = (
        values.withColumn("ends", limits)
        .select("x", "n", "ends.lo", "ends.hi")
        .withColumn("g", guess)
        .select(
            (
                F.when(F.col("x") < edge(F.col("g")), F.col("g") - 1)
                .when(
                    (F.col("x") >= edge(F.col("g") + 1)) & (F.col("g") < bins - 1),
                    F.col("g") + 1,
                )
                .otherwise(F.col("g"))
            ).alias("bin"),
            "n",
        )
    )
    counts = placed.groupBy("bin").agg(F.sum("n").alias("n"))
    frame = (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .withColumn("ends", limits)
        .select("bin", "ends.lo", "ends.hi")
        .where(F.col("lo").isNotNull())
        .select("bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"))
    )
    return frame.join(counts, "bin", "left").select(
        F.col("bin").cast("int").alias("bin"),
        "low",
        "high",
        F.coalesce("n", F.lit(0)).alias("n"),
    )
