from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import nearest as nn

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, score string"


def brute(rows, k):
    """query → the k best (id, score), ties to the smaller id."""
    good = {}
    for i, v in rows:
        whole = i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
        if whole and any(v):
            good[i] = np.array(v, np.float64)
    out = {}
    for i, q in good.items():
        if i % 50 == 0:
            near = [
                (-float(np.dot(q, c) / math.sqrt(np.dot(q, q)) / math.sqrt(np.dot(c, c))), j)
                for j, c in good.items()
                if j != i and len(c) == len(q)
            ]
            if near:
                out[i] = [(j, -s) for s, j in sorted(near, key=lambda x: (round(x[0], 12), x[1]))[:k]]
    return out


def run(spark, rows, **sizes):
    df = spark.createDataFrame([(i, v, 0, "a", "b", "c") for i, v in rows], SCHEMA)
    found = {}
    for r in nn.nearest(df, F.col("vec_id") % 50 == 0, **sizes).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q, hits in found.items():
        assert [h[0] for h in sorted(hits)] == list(range(1, len(hits) + 1))
        found[q] = [(i, s) for _, i, s in sorted(hits)]
    return found


def test_defined_cases_are_exact(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.standard_normal(8).astype(np.float32).tolist()) for i in range(120)]
    rows += [(i, rows[3][1]) for i in range(300, 340)]  # equal vectors
    rows += [(400, None), (450, [0.0] * 8), (500, [float("nan")] + [1.0] * 7), (550, [None] + [1.0] * 7)]
    rows += [(600, [float("inf")] + [1.0] * 7), (None, rows[0][1]), (rows[5][0], rows[5][1]), (650, [1.0, 2.0])]
    rows += [(700, [1.0, 2.0, 3.0]), (701, [1.0, 2.0, 2.0])]
    got, want = run(spark, rows, candidate_block=64, query_block=2), brute(rows, 5)
    assert got.keys() == want.keys() and 700 in got and len(got[700]) == 1 and 650 not in got
    for q, hits in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in hits]
        assert np.allclose([s for _, s in got[q]], [s for _, s in hits], atol=1e-12)


def test_empty(spark):
    assert run(spark, [(1, [1.0, 2.0])]) == {}
    assert nn.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("spread", [1.0, 0.2])
def test_recall(spark, spread):
    draw = np.random.default_rng(2)
    centres = draw.standard_normal((10, 64))
    vectors = (centres[draw.integers(0, 10, 4000)] + spread * draw.standard_normal((4000, 64))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got, want = run(spark, rows, candidate_block=2000, query_block=50), brute(rows, 5)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


def test_chi_square():
    assert abs(nn.chi_square_cdf(nn.stop_ratio(0.95, 8), 8) - 0.95) < 1e-9
    assert abs(nn.stop_ratio(0.95, 8) - 15.507) < 1e-2


def test_tree_holds_every_row():
    points = np.repeat(np.random.default_rng(3).standard_normal((40, nn.PROJECTED)), 20, axis=0)
    tree = nn.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(800))
    assert (np.diff(tree.bounds, axis=1) <= nn.LEAF).all() and tree.bounds[:, 0].tolist()[1:] == tree.bounds[:-1, 1].tolist()
    far = tree.distances(points[0])
    for (a, b), d in zip(tree.bounds, far, strict=True):
        assert (((points[tree.order[a:b]] - points[0]) ** 2).sum(axis=1) >= d - 1e-9).all()


def test_vectors_of_one_id_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [-1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0, "a", "b", "c") for i, v in rows], SCHEMA)
    got = nn.nearest(df, F.col("vec_id") % 50 == 0, k=3).collect()
    found = sorted((r.rank, r.vec_id, round(r.score, 6)) for r in got)
    assert {r.query_id for r in got} == {0} and len(got) == 6
    near = round(1 / math.sqrt(1.01), 6)
    side = round(0.1 / math.sqrt(1.01), 6)
    # The first vector finds (1, 0.1), then its namesake and (0, 1); the second (0, 1) first.
    assert found == sorted([(1, 1, near), (2, 0, 0.0), (3, 1, 0.0), (1, 1, 1.0), (2, 1, side), (3, 0, 0.0)])
