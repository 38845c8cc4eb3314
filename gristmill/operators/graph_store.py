"""Changes of a stored graph: nodes by id, edges by their ends. Each is one commit, which
rewrites only the buckets that hold what it changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators import graph
from gristmill.sources.stored import Store

NODES, EDGES = "nodes", "edges"


def create(spark: SparkSession, path: str, nodes: DataFrame, edges: DataFrame, buckets: int = 64) -> Store:
    """Store a graph; edges of one pair of nodes lie in one bucket, whatever their type."""
    return Store.create(spark, path, {NODES: (nodes, ["id"]), EDGES: (edges, ["src", "dst"])}, buckets)


def merge_edges(store: Store, pairs: DataFrame, kind: str = "VIEWED") -> None:
    """``graph.merge_edges`` on the buckets of the pairs."""
    store.commit(store.change(EDGES, pairs, lambda rows: graph.merge_edges(rows, pairs, kind)))


def set_property(store: Store, match: Column, name: str, value) -> None:
    """Set a property that the nodes have a column for. The match is a filter of the stored scan;
    only the buckets of matching nodes are rewritten."""
    hit = store.table(NODES).where(match).select("id")
    store.commit(store.change(NODES, hit, lambda rows: graph.set_property(rows, match, name, value)))


def add_label(store: Store, chosen: DataFrame, label: str) -> None:
    """Add a label to the nodes whose id is in ``chosen``."""
    store.commit(store.change(NODES, chosen.select("id"), lambda rows: graph.add_label(rows, chosen, label)))


def create_path(
    store: Store,
    start: dict[str, object],
    end: dict[str, object],
    edge: dict[str, object],
    start_label: str = "Person",
    end_label: str = "Movie",
    kind: str = "ACTED_IN",
) -> None:
    """Two new nodes and the edge between them, shown by one commit. New ids follow the largest
    one; values that are lists stay lists."""
    spark = store.spark
    top = store.table(NODES).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]

    def rows_of(df: DataFrame, values: dict[str, object]) -> DataFrame:
        """One row with the table's types; what is not given is null."""
        return spark.createDataFrame([tuple(values.get(c) for c in df.columns)], df.schema)

    def added(table: str, *rows: dict[str, object]):
        schema_of = store.table(table, [])
        new = rows_of(schema_of, rows[0])
        for row in rows[1:]:
            new = new.unionByName(rows_of(schema_of, row))
        return store.change(table, new, lambda old: old.unionByName(new))

    nodes = added(
        NODES,
        {"id": top + 1, "labels": [start_label], **start},
        {"id": top + 2, "labels": [end_label], **end},
    )
    store.commit(nodes, added(EDGES, {"src": top + 1, "dst": top + 2, "type": kind, **edge}))
