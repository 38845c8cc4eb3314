"""State that one micro-batch leaves for the next, in two folders used by turns.

Batch N reads what batch N - 1 wrote and overwrites what batch N - 2 left, so a replayed
batch finds the state it had before, and nothing has to be removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _slot(path: str, batch_id: int) -> str:
    return f"{path}/slot={batch_id % 2}"


def before(spark: SparkSession, path: str, batch_id: int, schema: StructType) -> DataFrame:
    """The rows that the batch before left; none for the first batch."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_slot(path, batch_id - 1))


def leave(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(_slot(path, batch_id))
