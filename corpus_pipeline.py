"""A corpus pipeline: each stage works on what the one before it kept.

Documents are rows; their columns pass through unchanged except where a stage says so.
An empty table passes every stage and stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import decontaminate, jaccard_join, language_id, pieces, secret_scan, sentencepieces
from gristmill.llm.columns import prepared, remainder
from gristmill.plans.registry import Query
from gristmill.session import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Least share of a text's letters in its main language.
LEAST_SHARE = 0.5


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; those without letters or with mixed text go."""
    prepared(spark)
    model = language_id.fit(docs.where(remainder(F.col("doc_id"), 3) != 1))
    label = language_id.label_column(F.col("text"), model)
    found = docs.withColumn("__found", label)
    main = (F.col("__found.lang_pred") != language_id.UNDETERMINED) & (F.col("__found.score") >= LEAST_SHARE)
    return found.where(main).drop("__found")


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each class of near duplicates."""
    return jaccard_join.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced and ``n_chars`` renewed."""
    prepared(spark)
    columns = docs.columns
    cleaned = secret_scan.redact_column(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint")).select(columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    prepared(spark)
    model = pieces.read_model(pieces.default_path())
    return sentencepieces.encode_documents(docs, model)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_identified),
    ("jaccard_join", one_of_each_class),
    ("decontamination", without_benchmarks),
    ("secret_scans", redact_secrets),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each result is written below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prepared(spark)
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


PIPELINE = {"pipeline": Query(run, ORACLE_SQL)}
