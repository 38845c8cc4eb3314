"""Tables that change in place, bucket by bucket.

Rows lie in hash buckets of their keys. A change reads and rewrites the buckets of the keys
it touches; the others stay as they are. New files go to a folder of their own version, and
a manifest, one row per table and bucket, says which version counts. The manifest is written
last and as a whole, by one job commit: until then readers see the old rows, of all tables
alike, and a change that fails leaves nothing to see. Manifests are numbered; the last one
counts. One writer at a time. Null keys are keys. What a manifest no longer names is removed
by ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gristmill.sources.rolled import Options

MANIFEST = "table string, bucket int, version string, keys array<string>, schema string, buckets int, n bigint"


@dataclass(frozen=True)
class Change:
    """New rows of some buckets of a table, which take the place of what the buckets hold."""

    table: str
    buckets: tuple[int, ...]
    rows: DataFrame


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def create(cls, spark: SparkSession, path: str, tables: dict[str, tuple[DataFrame, Sequence[str]]], buckets: int = 64) -> Store:
        """A new store of tables, each with the keys of its rows."""
        store = cls(spark, path)
        heads = [(name, -1, None, list(keys), df.schema.json(), buckets) for name, (df, keys) in tables.items()]
        store._publish(0, heads, [Change(name, tuple(range(buckets)), df) for name, (df, _) in tables.items()])
        return store

    def _manifest(self) -> tuple[int, list]:
        rows = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest")
        newest = rows.agg(F.max("n")).first()[0]
        # One row per table and bucket.
        return newest, rows.where(F.col("n") == newest).drop("n").collect()

    def _head(self, manifest: list, table: str):
        return next(r for r in manifest if r["table"] == table and r["bucket"] < 0)

    @staticmethod
    def bucket(keys: Sequence[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def table(self, name: str, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a table, or of some of its buckets; the other buckets' files are not read."""
        return self._read(self._manifest()[1], name, only)

    def _read(self, manifest: list, name: str, only: Sequence[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(json.loads(self._head(manifest, name)["schema"]))
        places = [
            f"{self.path}/data/{name}/version={r['version']}/bucket={r['bucket']}"
            for r in manifest
            if r["table"] == name and r["bucket"] >= 0 and (only is None or r["bucket"] in only)
        ]
        if not places:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*places)

    def change(self, table: str, touched: DataFrame, update: Callable[[DataFrame], DataFrame]) -> Change:
        """``update`` of the rows in the buckets of the ``touched`` keys. It may change, add and drop
        rows, but only of keys in these buckets; nothing is written before ``commit``."""
        _, manifest = self._manifest()
        head = self._head(manifest, table)
        place = self.bucket(head["keys"], head["buckets"])
        # At most as many numbers as there are buckets.
        hit = tuple(sorted(r[0] for r in touched.select(place.alias("b")).distinct().collect()))
        rows = self._read(manifest, table, hit)
        return Change(table, hit, update(rows).select(*rows.columns))

    def commit(self, *changes: Change) -> None:
        """Write the new rows of all changes and show them at once."""
        if len({c.table for c in changes}) < len(changes):
            raise ValueError("one change of a table at a time")
        number, manifest = self._manifest()
        gone = {(c.table, b) for c in changes for b in c.buckets}
        kept = [tuple(r) for r in manifest if (r["table"], r["bucket"]) not in gone]
        self._publish(number + 1, kept, changes)

    def _publish(self, number: int, kept: list[tuple], changes: Sequence[Change]) -> None:
        heads = {r[0]: r for r in kept if r[1] < 0}
        new = []
        for change in changes:
            head = heads[change.table]
            version = uuid.uuid4().hex
            folder = f"{self.path}/data/{change.table}/version={version}"
            place = self.bucket(head[3], head[5])
            rows = change.rows.withColumn("bucket", place).repartition("bucket")
            rows.write.partitionBy("bucket").parquet(folder)
            written = self.spark.read.schema(rows.schema).parquet(folder)
            found = {r[0] for r in written.select("bucket").distinct().collect()}
            if not found <= set(change.buckets):
                raise ValueError(f"rows of {change.table} outside the buckets of the change")
            new += [(change.table, b, version, None, None, None) for b in sorted(found)]
        schema = MANIFEST.removesuffix(", n bigint")
        rows = self.spark.createDataFrame([*kept, *new], schema).coalesce(1)
        rows.write.json(f"{self.path}/manifest/n={number}")

    def versions(self, table: str) -> dict[int, str]:
        """The version of each bucket that has rows."""
        return {r["bucket"]: r["version"] for r in self._manifest()[1] if r["table"] == table and r["bucket"] >= 0}

    def vacuum(self) -> int:
        """Remove the files no longer named, when nobody reads them any more; how many folders went."""
        _, manifest = self._manifest()
        named = {(r["table"], r["version"], r["bucket"]) for r in manifest if r["bucket"] >= 0}
        system, base = Options(self.path).place()
        removed = 0
        for table in {r["table"] for r in manifest}:
            found = system.get_file_info(fs.FileSelector(f"{base}/data/{table}", recursive=True, allow_not_found=True))
            for info in found:
                parts = info.path.split("/")
                if info.type == fs.FileType.Directory and parts[-1].startswith("bucket="):
                    version, bucket = parts[-2].removeprefix("version="), int(parts[-1].removeprefix("bucket="))
                    if (table, version, bucket) not in named:
                        system.delete_dir(info.path)
                        removed += 1
        return removed
