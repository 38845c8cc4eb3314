"""Readers: JSON articles, text lines, delimited tables, streams of lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gristmill.functions.records import ARTICLE


def read_articles(
    spark: SparkSession, *paths: str, array_file: bool = False
) -> DataFrame:
    """Articles from any number of files or folders in one scan.

    JSON Lines by default, which Spark splits over tasks. ``array_file`` reads
    files that hold one JSON array each, one task per file; a broken file yields
    no rows. Wrongly typed fields become null.
    """
    if not array_file:
        return spark.read.schema(ARTICLE).option("mode", "PERMISSIVE").json(list(paths))
    marked = StructType([*ARTICLE.fields]).add("_broken", "string")
    rows = (
        spark.read.schema(marked)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_broken")
        .json(list(paths))
    )
    known = F.lit(False)
    for field in ARTICLE.fields:
        known = known | F.col(field.name).isNotNull()
    return rows.where(F.col("_broken").isNull() | known).drop("_broken")


def merge_parts(spark: SparkSession, folder: str, parts: int, **options) -> DataFrame:
    """Articles of the parts ``part=0`` .. that exist, in one scan. The pattern
    passes over missing ones; with none at all there are no rows."""
    numbers = ",".join(map(str, range(parts)))
    try:
        return read_articles(spark, f"{folder}/part={{{numbers}}}", **options)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ARTICLE)


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.text(list(paths))


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = False,
    names: Sequence[str] = (),
    view: str | None = None,
) -> DataFrame:
    """Delimited table. Fields that do not fit the schema become null and the row
    stays; without a schema types are inferred and ``names`` rename the columns
    by position. A byte-order mark is not part of the first field. ``view``
    registers the table for SQL.
    """
    reader = (
        spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    )
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    table = reader.csv(path)
    for old, new in zip(table.columns, names):
        table = table.withColumnRenamed(old, new)
    if view:
        table.createOrReplaceTempView(view)
    return table


def from_lines(spark: SparkSession, lines: Sequence[str]) -> DataFrame:
    """Lines held in the program."""
    return spark.createDataFrame([(line,) for line in lines], "value string")


def text_stream(
    spark: SparkSession,
    format: str = "text",
    files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """Stream with one column ``value``.

    ``text`` reads a folder (``path``), at most ``files_per_trigger`` new files
    per batch. ``socket`` and ``kafka`` pass their options on; message bytes are
    read as text, from the newest offset unless told otherwise.
    """
    reader = spark.readStream.format(format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if format == "kafka":
        options.setdefault("startingOffsets", "latest")
    stream = reader.options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def table_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A parquet table, a file or a folder of files, as a stream.

    A stream reads folders only. A single file is read through its folder, with its exact
    name as the filter; a folder is read by its exact path, so tables beside it are not.
    """
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    folder, _, name = path.rstrip("/").rpartition("/")
    if any(file.rstrip("/").endswith(f"/{name}") for file in table.inputFiles()):
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)
