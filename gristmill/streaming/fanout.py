"""One stream, several sinks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gristmill.streaming.runs import batch_path, start


@dataclass(frozen=True)
class Branch:
    """A view of the batch and the format it is written in."""

    view: Callable[[DataFrame], DataFrame]
    format: str = "csv"
    options: dict = field(default_factory=dict)


def fan_out(
    stream: DataFrame,
    branches: dict[str, Branch],
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write every branch of each batch to ``path/<branch>/batch_id=N``. The batch
    is computed once and kept while its branches are written."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, branch in branches.items():
                branch.view(batch).write.mode("overwrite").format(branch.format).options(
                    **branch.options
                ).save(batch_path(f"{path}/{name}", batch_id))
        finally:
            batch.unpersist()

    return start(stream, sink, checkpoint, "append", trigger)


def alerts(articles: DataFrame, limit: int = 100) -> DataFrame:
    """Much commented articles."""
    return articles.where(F.col("comment_count") > limit)
