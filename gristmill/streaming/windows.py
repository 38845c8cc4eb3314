"""Sliding-window counts over a table or a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text


def with_event_time(df: DataFrame, ts: str, late: str | None = "0 seconds") -> DataFrame:
    """Zoned time column ``at`` with a watermark (``late=None`` sets none). A
    stream that never runs backwards needs no allowance for late rows."""
    timed = df.withColumn("at", F.col(ts).cast("timestamp"))
    return timed.withWatermark("at", late) if late is not None else timed


def with_processing_time(df: DataFrame, late: str | None = None) -> DataFrame:
    """Time column ``at``: the start of the micro-batch. With a watermark windows
    finish, and their state goes, as time passes."""
    timed = df.withColumn("at", F.current_timestamp())
    return timed.withWatermark("at", late) if late is not None else timed


def _bounds(df: DataFrame, *rest: str) -> DataFrame:
    return df.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *rest,
    )


def timed_words(lines: DataFrame, value: str = "value") -> DataFrame:
    """ASCII-cleaned words with the time of their line, empty words included."""
    split = text.pieces(text.normalise_ascii(F.col(value)))
    return lines.select(F.explode(split).alias("word"), "at")


def word_windows(
    words: DataFrame, size: str = "30 seconds", slide: str = "15 seconds"
) -> DataFrame:
    """Count of each word per sliding window."""
    return _bounds(
        words.groupBy(F.window("at", size, slide), "word").agg(F.count(F.lit(1)).alias("n")),
        "word",
        "n",
    )


def keyword_windows(
    rows: DataFrame, hit: Column, size: str = "1 minute", slide: str = "10 seconds"
) -> DataFrame:
    """Rows per sliding window and how many of them pass the test."""
    return _bounds(
        rows.withColumn("_hit", hit.cast("int"))
        .groupBy(F.window("at", size, slide))
        .agg(
            F.count(F.lit(1)).alias("total_count"),
            F.sum("_hit").alias("keyword_count"),
        ),
        "total_count",
        "keyword_count",
    )


def word_order() -> list[Column]:
    """Order of the printed windows: by start, then by count."""
    return [F.col("window_start"), F.col("n").desc(), F.col("word")]
