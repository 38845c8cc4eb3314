"""SQL that fits a logistic regression anew, by Newton steps: the twin of a fitted model.

A step is one aggregate over the training rows (gradient and Hessian, numbers standardised),
followed by the elimination of its unknowns one by one on a table of cells.
"""

from __future__ import annotations

from collections.abc import Sequence


def fitted(train: str, test: str, keys: Sequence[str], target: str, features: Sequence[str], steps: int = 8) -> str:
    """Common table expressions that end in ``predicted``: keys, x (the features) and probability."""
    n = len(features) + 1
    key = ", ".join(keys)
    x = ", ".join(f'CAST("{f}" AS DOUBLE)' for f in features)
    means = ", ".join(f"avg(x[{i}])" for i in range(1, n))
    spreads = ", ".join(f"stddev_samp(x[{i}])" for i in range(1, n))
    scaled = ", ".join(f"(x[{i}] - m[{i}]) / CASE WHEN d[{i}] > 0 THEN d[{i}] ELSE 1 END" for i in range(1, n))
    sums = [f"sum(z[{i}] * z[{j}] * p * (1 - p))" for i in range(1, n + 1) for j in range(1, n + 1)]
    sums += [f"sum(z[{i}] * (y - p))" for i in range(1, n + 1)]
    # The Hessian's cells go by rows, the gradient is column n + 1. A constant feature has an
    # empty row and column: its coefficient stays 0.
    place = [(i, j) for i in range(1, n + 1) for j in range(1, n + 1)] + [(i, n + 1) for i in range(1, n + 1)]
    cells = ", ".join(f"({i}, {j})" for i, j in place)
    parts = [
        f"fit_rows AS MATERIALIZED (SELECT CAST({target} AS DOUBLE) AS y, [{x}] AS x FROM ({train}))",
        f"scales AS MATERIALIZED (SELECT [{means}] AS m, [{spreads}] AS d FROM fit_rows)",
        f"unit_rows AS MATERIALIZED (SELECT y, [1.0::DOUBLE, {scaled}] AS z FROM fit_rows, scales)",
        f"places AS (SELECT i, j, row_number() OVER () AS spot FROM (VALUES {cells}) c(i, j))",
        f"beta0 AS MATERIALIZED (SELECT [{', '.join(['0.0::DOUBLE'] * n)}] AS b)",
    ]
    for s in range(steps):
        parts += [
            f"""sums{s} AS MATERIALIZED (
    SELECT [{", ".join(sums)}] AS v FROM (
        SELECT y, z, 1 / (1 + exp(-list_dot_product(z, b))) AS p FROM unit_rows, beta{s}))""",
            f"cells{s}_0 AS MATERIALIZED (SELECT i, j, v[spot] AS v FROM sums{s}, places)",
        ]
        for k in range(1, n + 1):
            parts.append(
                f"""cells{s}_{k} AS MATERIALIZED (
    SELECT c.i, c.j, CASE WHEN abs(d.v) < 1e-9 THEN c.v WHEN c.i = {k} THEN c.v / d.v ELSE c.v - l.v * u.v / d.v END AS v
    FROM cells{s}_{k - 1} c JOIN cells{s}_{k - 1} l ON l.i = c.i AND l.j = {k} JOIN cells{s}_{k - 1} u ON u.i = {k} AND u.j = c.j
    JOIN cells{s}_{k - 1} d ON d.i = {k} AND d.j = {k})"""
            )
        parts.append(
            f"""beta{s + 1} AS MATERIALIZED (
    SELECT list(b[i] + v ORDER BY i) AS b FROM cells{s}_{n}, beta{s} WHERE j = {n + 1})"""
        )
    parts.append(
        f"""predicted AS MATERIALIZED (
    SELECT {key}, x, 1 / (1 + exp(-list_dot_product([1.0::DOUBLE, {scaled}], b))) AS probability
    FROM (SELECT {key}, [{x}] AS x FROM ({test})), scales, beta{steps})"""
    )
    return ",\n".join(parts)
