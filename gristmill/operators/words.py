"""Word and letter counts. The same functions take tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text


def explode_words(
    df: DataFrame, split: Column, *keep: str, min_length: int = 0, keep_empty: bool = False
) -> DataFrame:
    """One row per word, next to the kept columns."""
    words = df.select(*keep, F.explode(split).alias("word"))
    if min_length > 1:
        return words.where(F.length("word") >= min_length)
    return words if keep_empty else words.where(F.col("word") != "")


def count_by(words: DataFrame, *keys: str) -> DataFrame:
    return words.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def top(counts: DataFrame, k: int, *ties: str, by: str = "n") -> DataFrame:
    """The k largest; equal counts go by the tie columns."""
    return counts.orderBy(F.col(by).desc(), *ties).limit(k)


def word_counts(
    lines: DataFrame, value: str = "value", normalised: bool = True, min_length: int = 0
) -> DataFrame:
    """Count words of a text column, cleaned or as written."""
    source = F.col(value)
    source = text.normalise(source) if normalised else source
    return count_by(
        explode_words(lines, text.spaced(source), min_length=min_length), "word"
    )


def ascii_view(counts: DataFrame) -> DataFrame:
    """Show each counted word without its non-ASCII characters; words that become
    equal stay separate rows, words that vanish are hidden."""
    return counts.select(text.ascii_only(F.col("word")).alias("word"), "n").where(
        F.col("word") != ""
    )


def plain_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """Running-count variety: ASCII cleaning, and the empty word counts too."""
    split = text.pieces(text.normalise_ascii(F.col(value)))
    return count_by(explode_words(lines, split, keep_empty=True), "word")


def letter_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """Words made of ASCII letters only, counted by first letter."""
    words = lines.select(F.explode(text.word_runs(F.col(value))).alias("word"))
    return count_by(
        words.where(F.col("word").rlike("^[a-z]+$")).select(
            F.substring("word", 1, 1).alias("letter")
        ),
        "letter",
    )


def letter_events(lines: DataFrame, key: str, value: str = "value") -> DataFrame:
    """One row per word made of ASCII letters: the line's key, the word's number and first letter."""
    split = F.posexplode(text.word_runs(F.col(value))).alias("pos", "word")
    return lines.select(key, split).where(F.col("word").rlike("^[a-z]+$")).select(
        key, (F.col("pos") + 1).alias("pos"), F.substring("word", 1, 1).alias("letter")
    )


def log_lines(counts: DataFrame) -> DataFrame:
    """``letter: count`` lines."""
    return counts.select(F.format_string("%s: %d", "letter", "n").alias("line"))
