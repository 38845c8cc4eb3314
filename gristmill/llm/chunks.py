"""Texts dealt into chunks of bounded size, for work that combines before it shuffles.

A chunk is a run of adjacent rows of one input partition; it ends when its texts reach
``limit`` bytes, so only a single longer text makes a larger chunk, and neither a hot key
nor repeated rows do. Chunk numbers follow from the order of rows in a partition: the input
must be one that Spark reads the same way twice, such as a table.

All users of one ``dealt`` frame ask for the same columns, grouped by ``_chunk``, so Spark
shuffles the texts once and reads that shuffle again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHUNK_BYTES = 8 << 20
#: Numbers of chunks of one input partition.
STEP = 1 << 33


def numbered(lengths: list[int], state: list[int], limit: int) -> list[int]:
    """The running chunk number of each text; ``state`` is [number, bytes so far]."""
    out = []
    for n in lengths:
        if state[1] and state[1] + n > limit:
            state[0], state[1] = state[0] + 1, 0
        state[1] += n
        out.append(state[0])
    return out


def dealt(docs: DataFrame, limit: int = CHUNK_BYTES, **columns: Column) -> DataFrame:
    """``columns``, of which ``_text`` is the text, with ``_chunk`` and the row's number ``_row``."""
    narrow = docs.select(*[c.alias(name) for name, c in columns.items()])
    schema = StructType([*narrow.schema.fields]).add("_chunk", "long").add("_row", "long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) * STEP
        state, row = [0, 0], 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_pylist()
            chunk = np.array(numbered(lengths, state, limit), dtype=np.int64) + first
            rows = np.arange(row, row + len(chunk), dtype=np.int64)
            row += len(chunk)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunk), pa.array(rows)], schema=arrow)

    return narrow.mapInArrow(run, schema).repartition("_chunk")


def in_order(table: pa.Table) -> pa.Table:
    """The rows of a chunk as they were numbered."""
    return table.sort_by("_row")


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def unpacked(parts: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The values of a column of packed arrays, end to end."""
    return np.frombuffer(b"".join(parts.to_pylist()), dtype=kind)


