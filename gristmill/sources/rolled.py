"""Text and CSV files with a name of one's own, a largest size and a longest time open.

``df.write.format("rolled")`` and ``stream.writeStream.format("rolled")`` take

* ``path``, a folder all executors see (local, or any file system pyarrow knows),
* ``prefix`` and ``suffix`` of the file names (``part``, nothing),
* ``kind``: ``text`` (one column, a line per row, line breaks become spaces) or ``csv``,
* ``header`` for CSV, ``sep``,
* ``max_bytes`` (1 MiB): a file ends before the row that would make it longer; only a single
  longer row makes a longer file, and
* ``max_seconds`` (60): a file that has been open that long ends with the next row.

A task writes below ``_staging`` and reports its files. The driver moves the files of the
tasks that won to their names, then writes a manifest that lists them: a failed task, a
second attempt and a write that stops half-way leave nothing that a manifest lists, and a
write shows all its rows at once. ``read_rolled`` reads what the manifests list. The
manifest of a micro-batch carries its number, so a replayed batch takes the place of its
first run. Names are ``prefix-write-task-number suffix``. Overwriting removes earlier
manifests and then their files. An empty write leaves an empty manifest.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.types import StringType, StructType

# The rolling policy of the count files.
MAX_BYTES, MAX_SECONDS = 1 << 20, 60.0
STAGING, MANIFESTS = "_staging", "_manifests"


@dataclass(frozen=True)
class Options:
    path: str
    prefix: str = "part"
    suffix: str = ""
    kind: str = "text"
    header: bool = False
    sep: str = ","
    max_bytes: int = MAX_BYTES
    max_seconds: float = MAX_SECONDS

    @classmethod
    def of(cls, given: dict) -> Options:
        found = {k.lower(): v for k, v in given.items()}
        if "path" not in found:
            raise ValueError("the folder is missing: save(path) or option path")
        kinds = {"header": lambda v: str(v).lower() == "true", "max_bytes": int, "max_seconds": float}
        out = cls(**{k: kinds.get(k, str)(v) for k, v in found.items() if k in cls.__dataclass_fields__})
        if out.kind not in ("text", "csv"):
            raise ValueError(f"no kind of file: {out.kind!r}")
        return out

    def place(self) -> tuple[fs.FileSystem, str]:
        if ":/" not in self.path:
            return fs.LocalFileSystem(), self.path
        scheme, rest = self.path.split(":", 1)
        # Hadoop writes file:/folder for what a URI has as file:///folder.
        return fs.FileSystem.from_uri(self.path if rest.startswith("//") else f"{scheme}://{rest}")


def csv_field(column: pa.Array, sep: str) -> pa.Array:
    """Values as text, quoted where they need it; null is empty, an empty text is quoted."""
    value = pc.cast(column, pa.large_string())
    special = "[" + "".join(f"\\{c}" for c in sep) + '"\r\n]|^$|^ | $'
    quoted = pc.binary_join_element_wise(
        pa.scalar('"', pa.large_string()),
        pc.replace_substring(value, '"', '""'),
        pa.scalar('"', pa.large_string()),
        pa.scalar("", pa.large_string()),
    )
    return pc.fill_null(pc.if_else(pc.match_substring_regex(value, special), quoted, value), "")


def lines_of(batch: pa.RecordBatch, options: Options) -> pa.Array:
    """One line per row, with its line end."""
    end = pa.scalar("\n", pa.large_string())
    nothing = pa.scalar("", pa.large_string())
    if options.kind == "text":
        value = pc.fill_null(pc.cast(batch.column(0), pa.large_string()), "")
        return pc.binary_join_element_wise(pc.replace_substring_regex(value, "[\r\n]+", " "), end, nothing)
    fields = [csv_field(c, options.sep) for c in batch.columns]
    whole = pc.binary_join_element_wise(*fields, pa.scalar(options.sep, pa.large_string()))
    return pc.binary_join_element_wise(whole, end, nothing)


class Roller:
    """The files of one task."""

    def __init__(self, options: Options, names: Sequence[str], clock=time.monotonic):
        self.options, self.clock = options, clock
        self.system, self.folder = options.place()
        self.first = (",".join(f'"{n}"' for n in names) + "\n").encode() if options.header and options.kind == "csv" else b""
        self.first = self.first.replace(b",", options.sep.encode())
        self.staged: list[tuple[str, int, int]] = []
        self.out = None

    def _open(self) -> None:
        self.name = f"{self.folder}/{STAGING}/{uuid.uuid4().hex}"
        self.system.create_dir(f"{self.folder}/{STAGING}", recursive=True)
        self.out = self.system.open_output_stream(self.name, compression=None)
        self.out.write(self.first)
        self.size, self.rows, self.since = len(self.first), 0, self.clock()

    def close(self) -> None:
        if self.out:
            self.out.close()
            self.staged.append((self.name, self.rows, self.size))
            self.out = None

    def add(self, lines: pa.Array) -> None:
        """Write lines, as many at a time as fit the open file."""
        at = 0
        ends = pc.cumulative_sum(pc.cast(pc.binary_length(lines), pa.int64())).to_numpy()
        while at < len(lines):
            if self.out and self.rows and self.clock() - self.since >= self.options.max_seconds:
                self.close()
            if not self.out:
                self._open()
            done = int(ends[at - 1]) if at else 0
            fits = int(ends.searchsorted(done + self.options.max_bytes - self.size, side="right"))
            if fits <= at:
                if self.rows:
                    self.close()
                    continue
                fits = at + 1
            self.out.write("".join(lines.slice(at, fits - at).to_pylist()).encode())
            self.size, self.rows, at = self.size + int(ends[fits - 1]) - done, self.rows + fits - at, fits


@dataclass
class Written(WriterCommitMessage):
    task: int
    files: list


def write_task(options: Options, names: Sequence[str], batches: Iterator[pa.RecordBatch]) -> Written:
    roller = Roller(options, names)
    for batch in batches:
        if batch.num_rows:
            roller.add(lines_of(batch, options))
    roller.close()
    context = TaskContext.get()
    return Written(context.partitionId() if context else 0, roller.staged)


def publish(options: Options, write: str, messages: Sequence[Written | None], overwrite: bool) -> None:
    """Move the files of a write to their names and list them; the list is written last."""
    system, folder = options.place()
    manifest = f"{folder}/{MANIFESTS}/{write}.json"
    before = listed(options) if overwrite else {write: listed(options).get(write, [])}
    files = []
    for message in sorted((m for m in messages if m), key=lambda m: m.task):
        for number, (staged, rows, size) in enumerate(message.files):
            name = f"{options.prefix}-{write}-{message.task:05d}-{number:05d}{options.suffix}"
            system.move(staged, f"{folder}/{name}")
            files.append({"name": name, "rows": rows, "bytes": size})
    system.create_dir(f"{folder}/{MANIFESTS}", recursive=True)
    with system.open_output_stream(f"{manifest}.new", compression=None) as out:
        out.write(json.dumps({"kind": options.kind, "files": files}).encode())
    system.move(f"{manifest}.new", manifest)
    kept = {f["name"] for f in files}
    for name, old in before.items():
        if name != write:
            system.delete_file(f"{folder}/{MANIFESTS}/{name}.json")
        for f in old:
            if f["name"] not in kept:
                system.delete_file(f"{folder}/{f['name']}")


def drop(options: Options, messages: Sequence[Written | None]) -> None:
    system, _ = options.place()
    for message in messages:
        for staged, _, _ in message.files if message else ():
            system.delete_file(staged)


def listed(options: Options) -> dict[str, list[dict]]:
    """The files of every write, by the write's name."""
    system, folder = options.place()
    found = system.get_file_info(fs.FileSelector(f"{folder}/{MANIFESTS}", allow_not_found=True))
    out = {}
    for info in found:
        if info.path.endswith(".json"):
            with system.open_input_stream(info.path) as file:
                out[info.base_name.removesuffix(".json")] = json.loads(file.read())["files"]
    return out


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, options: Options, names: list[str], overwrite: bool):
        self.options, self.names, self.overwrite, self.run = options, names, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return write_task(self.options, self.names, iterator)

    def commit(self, messages) -> None:
        publish(self.options, self.run, messages, self.overwrite)

    def abort(self, messages) -> None:
        drop(self.options, messages)


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: Options, names: list[str]):
        self.options, self.names = options, names

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return write_task(self.options, self.names, iterator)

    def commit(self, messages, batchId: int) -> None:
        publish(self.options, f"batch{batchId:09d}", messages, overwrite=False)

    def abort(self, messages, batchId: int) -> None:
        drop(self.options, messages)


class Rolled(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rolled"

    def _checked(self, schema: StructType) -> tuple[Options, list[str]]:
        options = Options.of(self.options)
        if options.kind == "text" and (len(schema) != 1 or schema[0].dataType != StringType()):
            raise ValueError("text files take one column of strings")
        return options, schema.names

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(*self._checked(schema), overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(*self._checked(schema))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Rolled)


def read_rolled(spark: SparkSession, path: str, schema: StructType | str, kind: str = "csv", **options) -> DataFrame:
    """The rows of all files that a manifest lists. Null and empty CSV texts are told apart."""
    found = [f"{path}/{f['name']}" for files in listed(Options(path)).values() for f in files]
    if not found:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).options(**options)
    if kind == "csv":
        # The parser puts the null text in the place of an empty field that has no quotes.
        told = {"multiLine": True, "escape": '"', "emptyValue": "", "nullValue": "\x01null"}
        return reader.options(**told).csv(found)
    return reader.text(found)
