"""Nearest vectors by cosine, through stable projections and a kd-tree.

Vectors are scaled to length one, so that Euclidean order is cosine order, and projected to
``PROJECTED`` dimensions by Gaussian (2-stable) directions. For two vectors at distance d
the squared projected distance over d² follows a chi-square law. A block of candidates is
indexed by a kd-tree over its projections. A query takes the tree's leaves in order of
their projected distance and verifies their vectors exactly; it stops when a vector beyond
the next leaf would be nearer than the k-th best found with probability below
``1 - CONFIDENCE`` by that law.

Blocks of candidates meet blocks of queries; every block pair is one task's work of bounded
size, and the best k of each are merged. Nothing is fitted on the data.

Vectors that are null, zero, or hold null or non-finite components take no part, neither
do rows without an id. Vectors of other dimensions are never compared. Rows that repeat id
and vector count once; other vectors of one id are rows of their own: each can be found, by
the others too, and each that asks has results of its own under the same id. Of equal vectors only the k + 1 smallest ids can be in a result, so only they are
indexed. Ties go to the smaller id. A query with fewer candidates than k gets them all; a
query without candidates and an empty table give no row.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROJECTED = 8
CONFIDENCE = 0.97
LEAF = 32
#: Rows of a block of candidates and of queries.
CANDIDATE_BLOCK, QUERY_BLOCK = 16_384, 1_024
SEED = 20_240_601


def chi_square_cdf(x: float, degrees: int) -> float:
    """For an even number of degrees of freedom."""
    if math.isinf(x):
        return 1.0
    term = total = 1.0
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


@lru_cache(8)
def stop_ratio(confidence: float, degrees: int) -> float:
    """The squared distance ratio at which the law reaches the confidence."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < confidence else (low, middle)
    return high


def directions(dimensions: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dimensions, PROJECTED))


class Tree:
    """A kd-tree over projections: leaves of at most ``LEAF`` rows, with their boxes.

    Nodes split at the median position of the widest side, so equal points split as well.
    """

    def __init__(self, points: np.ndarray):
        order = np.arange(len(points))
        open_nodes, leaves = [(0, len(points))], []
        while open_nodes:
            a, b = open_nodes.pop()
            if b - a <= LEAF:
                leaves.append((a, b))
                continue
            part = points[order[a:b]]
            side = int((part.max(axis=0) - part.min(axis=0)).argmax())
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, side], middle)]
            open_nodes += [(a, a + middle), (a + middle, b)]
        leaves.sort()
        self.order, self.bounds = order, np.array(leaves)
        starts = self.bounds[:, 0]
        self.low = np.minimum.reduceat(points[order], starts)
        self.high = np.maximum.reduceat(points[order], starts)

    def distances(self, point: np.ndarray) -> np.ndarray:
        """Squared projected distance from a point to every leaf's box."""
        outside = np.maximum(0, np.maximum(self.low - point, point - self.high))
        return np.einsum("ij,ij->i", outside, outside)


def search(
    vectors: np.ndarray, ids: np.ndarray, rows_of: np.ndarray, queries: np.ndarray, query_rows: np.ndarray, k: int
) -> list[tuple[int, int, float]]:
    """(query's place, id, cosine) of the best k per query among the rows of one block; ``rows_of`` and
    ``query_rows`` mark the rows, so that a query does not find itself."""
    norms = np.sqrt(np.sum(vectors * vectors, axis=1))
    own = np.sqrt(np.sum(queries * queries, axis=1))
    unit = vectors / norms[:, None]
    project = directions(vectors.shape[1])
    tree = Tree(unit @ project)
    unit, ids, vectors, norms = unit[tree.order], ids[tree.order], vectors[tree.order], norms[tree.order]
    rows_of = rows_of[tree.order]
    ratio = stop_ratio(CONFIDENCE, PROJECTED)
    units = queries / own[:, None]
    projected = units @ project
    found = []
    for q in range(len(queries)):
        far = tree.distances(projected[q])
        turn = np.argsort(far, kind="stable")
        cosines = np.full(len(ids), -np.inf)
        worst, done, step = math.inf, 0, 4
        best = np.full(k, -np.inf)
        while done < len(turn):
            # A k-th best at distance 0 stops only past all rows whose projections agree.
            if far[turn[done]] > ratio * worst:
                break
            leaves = turn[done : done + step]
            rows = np.concatenate([np.arange(a, b) for a, b in tree.bounds[leaves]])
            rows = rows[rows_of[rows] != query_rows[q]]
            near = unit[rows] @ units[q]
            cosines[rows] = near
            best = np.sort(np.concatenate([best, near]))[-k:]
            worst = max(0.0, 2 - 2 * best[0])
            done, step = done + step, min(2 * step, 64)
        chosen = np.flatnonzero((cosines >= best[0] - 1e-9) & np.isfinite(cosines))
        exact = np.sum(vectors[chosen] * queries[q], axis=1) / (norms[chosen] * own[q])
        rank = np.lexsort((ids[chosen], -exact))[:k]
        found += [(q, int(ids[chosen[r]]), float(exact[r])) for r in rank]
    return found


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.Array) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64)


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: finite, whole and not zero."""
    whole = F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)
    )
    return whole & F.exists(vector, lambda x: x != 0)


def nearest(
    rows: DataFrame,
    query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    candidate_block: int = CANDIDATE_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for the rows where ``query`` holds."""
    table = (
        rows.select(
            F.col(key).cast("bigint").alias("id"),
            F.col(vector).cast("array<double>").alias("v"),
            F.coalesce(query, F.lit(False)).alias("asks"),
        )
        .where(F.col("id").isNotNull() & usable(F.col("v")))
        .withColumn("dim", F.size("v"))
        .withColumn("row", F.xxhash64("id", "v"))
        .dropDuplicates(["id", "v"])
    )
    asked = table.where("asks").select("dim", F.col("id").alias("query_id"), F.col("row").alias("query_row"), "v")
    same = Window.partitionBy("dim", "h", "v").orderBy("id")
    kept = (
        table.withColumn("h", F.xxhash64("v"))
        .withColumn("n", F.row_number().over(same))
        .where(F.col("n") <= k + 1)
        .select("dim", "id", "row", "v")
    )
    sizes = table.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asks").alias("q"))
    sizes = sizes.select(
        "dim",
        F.ceil(F.col("n") / candidate_block).cast("int").alias("cs"),
        F.ceil(F.col("q") / query_block).cast("int").alias("qs"),
    )
    # Query rows go to every block of candidates and the reverse, by their block numbers.
    left = kept.join(sizes, "dim").where("qs > 0").select(
        "dim",
        F.pmod(F.xxhash64("id"), F.col("cs")).cast("int").alias("c"),
        F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("q"),
        "id",
        "row",
        "v",
    )
    right = asked.join(sizes, "dim").select(
        F.col("dim").alias("dim2"),
        F.explode(F.sequence(F.lit(0), F.col("cs") - 1)).alias("c2"),
        F.pmod(F.xxhash64("query_id"), F.col("qs")).cast("int").alias("q2"),
        "query_id",
        "query_row",
        F.col("v").alias("w"),
    )

    def pair(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and b.num_rows:
            size = a["dim"][0].as_py()
            out = search(
                _matrix(a["v"]).reshape(-1, size),
                a["id"].to_numpy(),
                a["row"].to_numpy(),
                _matrix(b["w"]).reshape(-1, size),
                b["query_row"].to_numpy(),
                k,
            )
        asks = pa.array([x[0] for x in out], pa.int64())
        return pa.table(
            {
                "query_id": b["query_id"].take(asks),
                "query_row": b["query_row"].take(asks),
                "id": pa.array([x[1] for x in out], pa.int64()),
                "score": pa.array([x[2] for x in out], pa.float64()),
            }
        )

    near = left.groupBy("dim", "c", "q").cogroup(right.groupBy("dim2", "c2", "q2")).applyInArrow(
        pair, "query_id bigint, query_row bigint, id bigint, score double"
    )
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
    )
