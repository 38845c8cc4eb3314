"""The article record."""

from __future__ import annotations

from pyspark.sql import types as T

ARTICLE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.ArrayType(T.StringType())),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("photo_count", T.IntegerType()),
        T.StructField("time", T.StringType()),
        T.StructField("comment_count", T.IntegerType()),
        T.StructField("category", T.StringType()),
    ]
)
