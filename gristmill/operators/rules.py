"""Fitted trees as tables of rules, and rows scored by them.

A rule is one leaf: the conditions on the way to it, its value and what the training rows
in it were. Nodes are numbered like a heap: the root is 1, below node i lie 2 i (at most the
threshold, or in the categories) and 2 i + 1. A model's table is read from its saved form;
it is as long as the model, which the driver holds anyway.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gristmill.session import scratch

RULES = (
    "tree int, leaf bigint, depth int, path string, n bigint, prediction double, impurity double,"
    " stats array<double>, conditions array<struct<feature:string,low:double,high:double,"
    "among:array<double>,others:array<double>>>"
)


def saved_nodes(model) -> list[tuple[int, Row]]:
    """(tree, node) of a fitted tree or forest, as its public saved form has them."""
    spark = SparkSession.getActiveSession()
    path = scratch(spark, "model")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").collect()
    return [(r["treeID"], r["nodeData"]) if "treeID" in r.asDict() else (0, r) for r in rows]


def _test(condition: dict) -> str:
    """A condition as text."""
    name = condition["feature"]
    if condition["among"] is not None:
        return f"{name} in {_numbers(condition['among'])}"
    if condition["others"] is not None:
        return f"{name} not in {_numbers(condition['others'])}"
    return f"{name} <= {condition['high']!r}" if condition["high"] is not None else f"{name} > {condition['low']!r}"


def _numbers(values: Sequence[float]) -> str:
    return "{" + ", ".join(f"{v:g}" for v in sorted(values)) + "}"


def _condition(feature: str, split: Row, left: bool) -> dict:
    values = list(split["leftCategoriesOrThreshold"])
    out = {"feature": feature, "low": None, "high": None, "among": None, "others": None}
    if split["numCategories"] >= 0:
        out["among" if left else "others"] = values
    else:
        out["high" if left else "low"] = values[0]
    return out


def rule_rows(nodes: Sequence[tuple[int, Row]], features: Sequence[str]) -> list[dict]:
    """One entry per leaf of every tree, in order of tree and leaf from left to right."""
    by_id = {(tree, node["id"]): node for tree, node in nodes}
    out = []
    for tree in sorted({tree for tree, _ in nodes}):
        open_nodes = [(0, 1, ())]
        while open_nodes:
            at, number, way = open_nodes.pop()
            node = by_id[tree, at]
            if node["leftChild"] < 0:
                out.append(
                    {
                        "tree": tree,
                        "leaf": number,
                        "depth": len(way),
                        "path": " and ".join(map(_test, way)),
                        "n": node["rawCount"],
                        "prediction": node["prediction"],
                        "impurity": node["impurity"],
                        "stats": list(node["impurityStats"]),
                        "conditions": list(way),
                    }
                )
                continue
            name = features[node["split"]["featureIndex"]]
            for child, side, left in (("rightChild", 2 * number + 1, False), ("leftChild", 2 * number, True)):
                open_nodes.append((node[child], side, (*way, _condition(name, node["split"], left))))
    return out


def rules(model, features: Sequence[str]) -> DataFrame:
    """The rules of a fitted tree or forest over ``features`` (in the order of its vector)."""
    return SparkSession.getActiveSession().createDataFrame(rule_rows(saved_nodes(model), features), RULES)


def _holds(condition: dict) -> Column:
    value = F.col(f"`{condition['feature']}`").cast("double")
    if condition["among"] is not None:
        return value.isin(*condition["among"])
    if condition["others"] is not None:
        return ~value.isin(*condition["others"])
    return value <= condition["high"] if condition["high"] is not None else value > condition["low"]


def leaf_column(found: Sequence[dict], tree: int = 0) -> Column:
    """The leaf a row falls into, as one expression over the feature columns: the nested
    conditions of the tree, so that a row takes as many tests as its leaf is deep. A row with
    a null in a feature that is asked for has no leaf."""
    own = {r["leaf"]: r for r in found if r["tree"] == tree}

    def below(number: int, depth: int) -> Column:
        if number in own:
            return F.lit(number).cast("bigint")
        inside = next(r for leaf, r in own.items() if _under(leaf, 2 * number))
        test = _holds(inside["conditions"][depth])
        return F.when(test, below(2 * number, depth + 1)).when(~test, below(2 * number + 1, depth + 1))

    return below(1, 0)


def _under(leaf: int, number: int) -> bool:
    while leaf > number:
        leaf >>= 1
    return leaf == number


def with_leaves(rows: DataFrame, found: Sequence[dict], name: str = "leaves") -> DataFrame:
    """Add the leaf of each tree, in the order of the trees."""
    trees = sorted({r["tree"] for r in found})
    return rows.withColumn(name, F.array(*[leaf_column(found, t) for t in trees]))


def values_of(found: Sequence[dict], leaves: Column, value: str = "prediction") -> Column:
    """The rules' values of an array of leaves, one per tree, in its order."""
    trees = sorted({r["tree"] for r in found})
    maps = []
    for t in trees:
        entries = [F.lit(x) for r in found if r["tree"] == t for x in (r["leaf"], float(r[value]))]
        maps.append(F.create_map(*entries))
    return F.array(*[F.element_at(m, F.get(leaves, i)) for i, m in enumerate(maps)])


def leaf_facts(train: DataFrame, found: Sequence[dict], target: str) -> DataFrame:
    """``tree``, ``leaf`` with the number, mean and variance of the target over the training rows on
    its path: what the leaf's value must be, counted anew from the rows in one aggregate."""
    trees = sorted({r["tree"] for r in found})
    numbered = with_leaves(train, found, "_leaves").select(F.posexplode("_leaves").alias("_i", "leaf"), target)
    tree = F.element_at(F.array(*[F.lit(t) for t in trees]), F.col("_i") + 1)
    return numbered.groupBy(tree.alias("tree"), "leaf").agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean"), F.var_pop(target).alias("variance")
    )


def mean_of(values: Column, n: int) -> Column:
    return reduce(lambda a, b: a + b, [F.get(values, i) for i in range(n)]) / n
