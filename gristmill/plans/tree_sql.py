"""SQL that grows the trees of ``operators.models`` anew: the twin of a fitted model.

A level of the trees is a few common table expressions: sums per node, feature and value,
running sums, the best cut of each node, and the rows moved to the nodes below. Cuts lie
half-way between neighbouring values of the whole training table. The best cut has the
largest gain; ties go to the earlier feature, then to the smaller value.
"""

from __future__ import annotations

from collections.abc import Sequence


def grown(
    train: str, test: str, keys: Sequence[str], target: str, features: Sequence[Sequence[str]], depth: int, least: int, bag: str = "true"
) -> str:
    """``WITH`` clause that ends in ``scored``: tree, keys, node, n, value for every test row and tree.
    ``features`` has one list per tree; ``bag`` says which training rows tree ``tree`` sees."""
    names = list(dict.fromkeys(f for own in features for f in own))
    uses = ", ".join(f"({t}, {names.index(f) + 1}, {i})" for t, own in enumerate(features) for i, f in enumerate(own))
    x = ", ".join(f'CAST("{f}" AS DOUBLE)' for f in names)
    key = ", ".join(keys)
    trees = ", ".join(f"({t})" for t in range(len(features)))
    rows = f"SELECT tree, {key}, {{y}}, [{x}] AS x, 1::BIGINT AS node FROM ({{table}}) r, (VALUES {trees}) t(tree)"
    parts = [
        f"uses(tree, f, ord) AS (VALUES {uses})",
        f"t0 AS MATERIALIZED ({rows.format(y=f'CAST({target} AS DOUBLE) AS y', table=train)} WHERE {bag})",
        f"e0 AS MATERIALIZED ({rows.format(y='0 AS y', table=test)})",
        """grid AS MATERIALIZED (
    SELECT tree, f, v, (v + lead(v) OVER (PARTITION BY tree, f ORDER BY v)) / 2 AS mid
    FROM (SELECT DISTINCT tree, f, x[f] AS v FROM t0 JOIN uses USING (tree)))""",
    ]
    moved = "CASE WHEN b.f IS NULL THEN r.node WHEN r.x[b.f] <= b.mid THEN 2 * r.node ELSE 2 * r.node + 1 END"
    for i in range(depth):
        parts += [
            f"""s{i} AS MATERIALIZED (
    SELECT tree, node, f, x[f] AS v, count(*) AS n, sum(y) AS s FROM t{i} JOIN uses USING (tree) GROUP BY ALL)""",
            f"""c{i} AS MATERIALIZED (
    SELECT *, sum(n) OVER low AS nl, sum(s) OVER low AS sl, sum(n) OVER node_rows AS nt, sum(s) OVER node_rows AS st
    FROM s{i} WINDOW low AS (PARTITION BY tree, node, f ORDER BY v), node_rows AS (PARTITION BY tree, node, f))""",
            f"""b{i} AS MATERIALIZED (
    SELECT tree, node, f, mid FROM (
        SELECT *, sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt AS gain FROM c{i}
        WHERE nl >= {least} AND nt - nl >= {least})
    JOIN uses USING (tree, f) JOIN grid USING (tree, f, v) WHERE gain > 1e-9
    QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, ord, v) = 1)""",
        ]
        parts += [
            f"{x}{i + 1} AS MATERIALIZED (SELECT r.* REPLACE ({moved} AS node) FROM {x}{i} r LEFT JOIN b{i} b USING (tree, node))"
            for x in "te"
        ]
    parts += [
        f"leaves AS MATERIALIZED (SELECT tree, node, count(*) AS n, avg(y) AS value FROM t{depth} GROUP BY ALL)",
        f"scored AS MATERIALIZED (SELECT tree, {key}, node, n, value FROM e{depth} JOIN leaves USING (tree, node))",
    ]
    return "WITH " + ",\n".join(parts)
