"""Named queries over the given tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gristmill.session import tune

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name."""

    def register(run: Run) -> Run:
        def tuned(spark: SparkSession, folder: str) -> DataFrame:
            return run(tune(spark), folder)

        tuned.__name__, tuned.__doc__ = run.__name__, run.__doc__
        QUERIES[run.__name__] = Query(tuned, sql)
        return run

    return register
