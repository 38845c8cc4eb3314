"""Run the queries beside their SQL twins: ``python -m tests.oracle [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

DATA = "/root/testdata"

# Spark type -> DuckDB type of the same values.
SAME = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _key(row) -> tuple:
    return tuple((v is None, type(v).__name__, v if v is not None else 0) for v in row)


def compare(df, db, sql: str) -> list[str]:
    """What differs between a Spark result and its twin."""
    names = sorted(df.columns)
    types = dict(df.dtypes)
    rel = db.sql(sql)
    faults = []
    if sorted(rel.columns) != names:
        return [f"columns {names} / {sorted(rel.columns)}"]
    twin_types = dict(zip(rel.columns, map(str, rel.types)))
    for n in names:
        if SAME.get(types[n]) != twin_types[n]:
            faults.append(f"type {n}: {types[n]} / {twin_types[n]}")
    ours = sorted((tuple(r) for r in df.select(*names).collect()), key=_key)
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(db.sql(f"SELECT {quoted} FROM ({sql})").fetchall(), key=_key)
    if len(ours) != len(theirs):
        faults.append(f"rows {len(ours)} / {len(theirs)}")
    for a, b in zip(ours, theirs):
        same = all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        )
        if not same:
            faults.append(f"row {str(a)[:300]} / {str(b)[:300]}")
            break
    return faults


def main() -> None:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    args = sys.argv[1:]
    folder = f"{DATA}/{args[0] if args else 'sf0.01'}"
    wanted = args[1:] or list(entry.queries())
    spark = make_session()
    db = connect(folder)
    twins, bad = entry.oracle_sql(), 0
    for name in wanted:
        began = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            faults = compare(df, db, twins[name]) if name in twins else []
            note = "ok" if name in twins else f"rows only: {df.count()}"
        except Exception as error:
            faults, note = [f"{type(error).__name__}: {str(error)[:400]}"], ""
        bad += bool(faults)
        print(f"{time.time() - began:6.1f}s {name}: {'; '.join(faults) or note}", flush=True)
    print(f"{bad} of {len(wanted)} differ")


if __name__ == "__main__":
    main()
