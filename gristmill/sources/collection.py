"""Collections of JSON documents: the whole document as VARIANT, often used fields as columns.

A load takes JSON texts as they are and appends them as one table. Each named field gets a
column of its own type, which a query on it reads without the documents; any other path is
read out of the VARIANT. A field that is missing, null or of another type is null. A text
that is no JSON is kept in ``raw`` with a null document, so that no input is lost. The named
fields stand in the table's column metadata, so a reader needs the path only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT, RAW = "_doc", "_raw"


def _column(path: str) -> str:
    """The column of a path such as ``a.b``."""
    return path.replace(".", "__")


def load(texts: DataFrame, path: str, fields: dict[str, str], value: str = "value", mode: str = "append") -> None:
    """Load JSON texts into the collection at ``path``. ``fields`` gives the type of each field that
    is often used, by its path; a later load names the same ones."""
    parsed = texts.select(F.try_parse_json(value).alias(DOCUMENT), F.col(value).alias(RAW))
    shredded = [
        F.try_variant_get(DOCUMENT, f"$.{name}", kind).alias(_column(name), metadata={"path": name, "type": kind})
        for name, kind in fields.items()
    ]
    kept = F.when(F.col(DOCUMENT).isNull(), F.col(RAW)).alias(RAW)
    parsed.select(*shredded, DOCUMENT, kept).write.mode(mode).parquet(path)


class Collection:
    def __init__(self, spark: SparkSession, path: str):
        self.rows = spark.read.parquet(path)
        self.fields = {f.metadata["path"]: f for f in self.rows.schema.fields if "path" in f.metadata}

    def field(self, path: str, kind: str | None = None) -> Column:
        """A field by its path: its own column if it has one of that type, else out of the document."""
        own = self.fields.get(path)
        if own is not None and kind in (None, own.metadata["type"]):
            return F.col(_column(path))
        if kind is None:
            raise ValueError(f"{path} has no column: give its type")
        return F.try_variant_get(DOCUMENT, f"$.{path}", kind)

    def find(self, *wanted: str | tuple[str, str], where: Column | None = None) -> DataFrame:
        """The fields of all documents, each a path or a path and a type; ``where`` is a condition on
        ``field`` columns. Texts that are no JSON are not documents."""
        named = [(w, None) if isinstance(w, str) else w for w in wanted]
        rows = self.rows.where(F.col(RAW).isNull())
        rows = rows if where is None else rows.where(where)
        return rows.select(*[self.field(p, kind).alias(p.rsplit(".", 1)[-1]) for p, kind in named])

    def rejected(self) -> DataFrame:
        """The loaded texts that are no JSON."""
        return self.rows.where(F.col(RAW).isNotNull()).select(F.col(RAW).alias("value"))
