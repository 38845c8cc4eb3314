"""Writers of batch results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.operators.order import with_position

# Fixed value: records per exported text file.
CHUNK = 30_000


def write_articles(articles: DataFrame, path: str, by: str | None = None) -> None:
    """JSON Lines; ``by`` names a column whose values get folders ``by=value``."""
    writer = articles.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(by)
    writer.json(path)


def write_lines(
    df: DataFrame, path: str, column: str = "value", per_file: int | None = None
) -> None:
    """One text line per row; line breaks inside a value become spaces, so that a
    row stays a line. ``per_file`` starts a new file after that many rows."""
    writer = df.select(F.regexp_replace(column, r"[\r\n]+", " ").alias("value")).write.mode(
        "overwrite"
    )
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.text(path)


def write_csv(
    df: DataFrame, path: str, header: bool = True, sep: str = ",", per_file: int | None = None
) -> None:
    writer = df.write.mode("overwrite").option("header", header).option("sep", sep)
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.csv(path)


def write_sorted(df: DataFrame, path: str, *keys: str, sep: str = "\t") -> None:
    """Delimited output in key order over all files."""
    write_csv(df.orderBy(*keys), path, header=False, sep=sep)


def write_chunks(df: DataFrame, path: str, order: Sequence[str], column: str = "value", size: int = CHUNK) -> None:
    """Files of exactly ``size`` records, the last one of the rest: record ``pos`` of the whole table,
    in the given order, is in the folder ``chunk=(pos - 1) div size``, which holds one file, sorted.
    A line is the position, a tab and the text; line breaks inside a text become spaces."""
    line = F.regexp_replace(column, r"[\r\n\t]+", " ").alias("value")
    placed = with_position(df.select(*order, line), order)
    chunks = placed.select("pos", "value", F.expr(f"(pos - 1) div {size}").alias("chunk"))
    # A chunk is one task's work, however many there are.
    dealt = chunks.repartition("chunk").sortWithinPartitions("chunk", "pos")
    dealt.write.mode("overwrite").partitionBy("chunk").option("sep", "\t").csv(path)
