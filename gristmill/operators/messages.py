"""Article fields from JSON messages, for tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import times


def _first(doc: Column, *names: str) -> Column:
    """First of the keys that is present, even if it holds a JSON null."""
    return F.coalesce(*[F.try_variant_get(doc, f"$.{n}", "variant") for n in names])


def _text(name: str) -> Column:
    return F.try_variant_get(F.col(name), "$", "string")


def _kind(name: str) -> Column:
    """Type name of a JSON value, ``MISSING`` where the key is absent."""
    return F.coalesce(F.schema_of_variant(F.col(name)), F.lit("MISSING"))


def parse_articles(messages: DataFrame, *keep: str, value: str = "value") -> DataFrame:
    """Kept columns, then title, comment_count, publish_ts, content per message.

    Two spellings are known for the count and the time. Whatever cannot be read
    (broken JSON, a null or non-numeric count, a bad time) turns the whole
    message into the default record; the row itself always stays.

    The steps are separate projections so that each message is parsed once. The
    generator at the end yields one row per row; it keeps filters on the result
    from being pushed below, where they would parse a second time.
    """
    fields = (
        messages.select(*keep, F.try_parse_json(value).alias("_doc"))
        .select(
            *keep,
            _kind("_doc").alias("_doc_kind"),
            _first(F.col("_doc"), "title").alias("_title"),
            _first(F.col("_doc"), "comment_count", "commentCount").alias("_count"),
            _first(F.col("_doc"), "datePublished", "time").alias("_time"),
            _first(F.col("_doc"), "content").alias("_content"),
        )
        .select(
            "*",
            _kind("_title").alias("_title_kind"),
            _kind("_count").alias("_count_kind"),
            _kind("_content").alias("_content_kind"),
            _text("_count").alias("_count_text"),
            F.coalesce(_text("_time"), F.lit("")).alias("_time_text"),
        )
    )
    kind = F.col("_count_kind")
    count = (
        F.when(kind == "MISSING", F.lit(0))
        .when(
            (kind == "STRING") & F.col("_count_text").rlike(r"^\s*[+-]?\d+\s*$"),
            F.col("_count_text").try_cast("int"),
        )
        .when(
            kind.isin("BIGINT", "DOUBLE", "BOOLEAN") | kind.startswith("DECIMAL"),
            F.try_variant_get(F.col("_count"), "$", "int"),
        )
    )
    items = F.try_variant_get(F.col("_content"), "$", "array<variant>")
    all_text = F.forall(items, lambda x: F.coalesce(F.schema_of_variant(x), F.lit("VOID")) == "STRING")
    # One item that is no text makes the whole content unreadable.
    lines = F.when(all_text, F.try_variant_get(F.col("_content"), "$", "array<string>"))
    body = (
        F.when(F.col("_content_kind") == "MISSING", F.lit(""))
        .when(F.col("_content_kind").startswith("ARRAY"), F.array_join(lines, " "))
        .otherwise(_text("_content"))
    )
    title = F.when(F.col("_title_kind") == "MISSING", F.lit("")).otherwise(_text("_title"))
    read = fields.select(
        *keep,
        F.col("_doc_kind").startswith("OBJECT").alias("_object"),
        title.alias("_title"),
        count.alias("_count"),
        (F.col("_time_text") != "").alias("_timed"),
        times.parse_iso(F.col("_time_text")).alias("_at"),
        body.alias("_body"),
    )
    good = (
        F.col("_object")
        & F.col("_count").isNotNull()
        & (~F.col("_timed") | F.col("_at").isNotNull())
    )
    record = F.struct(
        F.when(good, F.col("_title")).otherwise(F.lit("")).alias("title"),
        F.when(good, F.col("_count")).otherwise(F.lit(0)).alias("comment_count"),
        F.when(good, F.col("_at")).alias("publish_ts"),
        F.when(good, F.col("_body")).otherwise(F.lit("")).alias("content"),
    )
    return read.select(*keep, F.inline(F.array(record)))
