"""Rules against the models they come from, leaves against their rows, fits against their optimum."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from gristmill.operators import models, rules

FEATURES = ["a", "b", "kind"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(11)
    data = []
    for i in range(600):
        a, b, kind = draw.randint(0, 30) / 2, draw.randint(0, 9), draw.choice("uvwxyz")
        y = a * (b > 4) + {"u": 3.0, "v": -2.0}.get(kind, 0.0) + draw.random()
        data.append((i, a, b, kind, y, float(y > 5)))
    df = spark.createDataFrame(data, "id int, a double, b int, letter string, y double, label double")
    indexed = StringIndexer(inputCol="letter", outputCol="kind").fit(df).transform(df)
    return models.assemble(indexed, FEATURES, "error").cache()


@pytest.mark.parametrize(
    "estimator",
    [
        lambda: DecisionTreeRegressor(labelCol="y", maxDepth=4),
        lambda: DecisionTreeClassifier(labelCol="label", maxDepth=5),
        lambda: RandomForestClassifier(labelCol="label", numTrees=4, maxDepth=4, bootstrap=False, seed=3),
        lambda: DecisionTreeRegressor(labelCol="y", maxDepth=0),
    ],
    ids=["regressor", "classifier", "forest", "root"],
)
def test_rules_score_as_the_model(rows, estimator):
    model = estimator().fit(rows)
    found = rules.rule_rows(rules.saved_nodes(model), FEATURES)
    scored = rules.with_leaves(rows, found)
    trees = sorted({r["tree"] for r in found})
    if len(trees) == 1:
        # A saved classifier holds its leaves' classes, a regressor their means.
        mine = F.get(rules.values_of(found, F.col("leaves")), 0)
    else:
        shares = [{**r, "share": r["stats"][1] / sum(r["stats"])} for r in found]
        mine = (rules.mean_of(rules.values_of(shares, F.col("leaves"), "share"), len(trees)) > 0.5).cast("double")
    got = scored.select("id", "features", mine.alias("mine"))
    wrong = model.transform(got).where(F.abs(F.col("prediction") - F.col("mine")) > 1e-9)
    assert wrong.count() == 0
    assert got.where("mine is null").count() == 0


def test_leaves_hold_what_their_rows_say(rows):
    model = DecisionTreeRegressor(labelCol="y", maxDepth=4).fit(rows)
    found = rules.rule_rows(rules.saved_nodes(model), FEATURES)
    facts = {r["leaf"]: r for r in rules.leaf_facts(rows, found, "y").collect()}
    assert sorted(facts) == sorted(r["leaf"] for r in found)
    for rule in found:
        fact = facts[rule["leaf"]]
        assert fact["n"] == rule["n"]
        assert fact["mean"] == pytest.approx(rule["prediction"])
        assert fact["variance"] == pytest.approx(rule["impurity"], abs=1e-6)


def test_unbagged_forest_votes_are_the_rows_on_the_paths(rows):
    forest = RandomForestClassifier(labelCol="label", numTrees=3, maxDepth=3, bootstrap=False, seed=5).fit(rows)
    found = rules.rule_rows(rules.saved_nodes(forest), FEATURES)
    facts = {(r["tree"], r["leaf"]): r for r in rules.leaf_facts(rows, found, "label").collect()}
    for rule in found:
        fact = facts[rule["tree"], rule["leaf"]]
        assert (fact["n"], round(fact["mean"] * fact["n"])) == (rule["n"], rule["stats"][1])


def test_rule_table_reads_as_text(spark, rows):
    model = DecisionTreeRegressor(labelCol="y", maxDepth=2).fit(rows)
    table = rules.rules(model, FEATURES).orderBy("leaf").collect()
    assert table[0]["path"].count(" and ") == table[0]["depth"] - 1
    assert {r["tree"] for r in table} == {0}
    assert all(c["feature"] in FEATURES for r in table for c in r["conditions"])


def test_a_null_feature_has_no_leaf(spark, rows):
    model = DecisionTreeRegressor(labelCol="y", maxDepth=1).fit(rows)
    found = rules.rule_rows(rules.saved_nodes(model), FEATURES)
    empty = spark.createDataFrame([(None, None, None)], "a double, b int, kind double")
    assert rules.with_leaves(empty, found).first()["leaves"] == [None]


def flights(spark, n=400):
    draw = random.Random(2)
    data = []
    for i in range(n):
        distance, carrier = draw.randint(1, 50), draw.choice("AB")
        late = distance + (20 if carrier == "A" else 0) + draw.randint(-20, 20) > 35
        data.append((2000, 1 + i % 12, 1 + i % 28, 1 + i % 7, 100 * (i % 24), 100 * (i % 11), carrier,
                     str(10 * (i % 9)), draw.choice("XYZ"), draw.choice("XYZ"), distance, 0, str(5 if late else -5), i))
    kinds = ["int"] * 6 + ["string"] * 4 + ["int", "int", "string", "int"]
    schema = ", ".join(f"{c} {k}" for c, k in zip([*models.FLIGHT_COLUMNS, "id"], kinds))
    return models.delay_rows(spark.createDataFrame(data, schema), keep=["id"])


def test_logistic_fit_is_at_its_optimum(spark):
    data = flights(spark)
    predicted, fit_on, model = models.logistic_model(data, data, tol=1e-12, steps=500)
    assert max(map(abs, models.logistic_gradient(fit_on, model))) < 1e-6
    larger = max(r["count"] for r in data.groupBy("label").count().collect()) / data.count()
    assert models.accuracy(predicted).first()["accuracy"] > larger + 0.1
    # One step away from the optimum the gradient is not small.
    rough = models.logistic_model(data, data, steps=1)[2]
    assert max(map(abs, models.logistic_gradient(fit_on, rough))) > 1e-3


def test_subspace_forest_does_not_depend_on_partitions(spark):
    data = flights(spark)
    got = []
    for parts in (1, 5):
        predicted, _ = models.subspace_forest(data.repartition(parts), data, ["id"], least=20)
        got.append({r["id"]: (r["leaves"], round(r["probability"], 9)) for r in predicted.collect()})
    assert got[0] == got[1] and len(got[0]) == data.count()
    right = models.accuracy(predicted).first()["accuracy"]
    assert right > 0.75


def test_an_index_of_many_labels_collects_nothing(spark):
    rows = spark.range(200_000).select(
        F.concat(F.lit("v"), F.col("id") % 150_000).alias("a"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("b"),
    )
    table = models.index_table(rows, ["a", "b"])
    got = table.groupBy("field").agg(F.count("*"), F.count_distinct("idx"), F.min("idx"), F.max("idx")).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == {"a": (150_000, 150_000, 0.0, 149_999.0), "b": (66_667, 66_667, 0.0, 66_666.0)}
    assert table.where("idx = 0").orderBy("field").collect()[1]["value"] == "hot"
    twice = table.where("field = 'a' and idx < 50000").join(rows.select(F.col("a").alias("value")), "value").count()
    assert twice == 100_000  # labels that occur twice come first
    out = models.indexed_by(rows, table, ["a", "b"])
    assert out.count() == rows.where("b is not null").count()
    assert out.where("b = 'hot'").select("b_index").distinct().collect()[0][0] == 0.0


@pytest.mark.parametrize("frequent", [models.FREQUENT, 3, 1], ids=["all", "few", "one"])
def test_rows_of_a_common_label_do_not_meet_in_one_task(spark, frequent):
    kinds = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("v"), F.col("id") % 100))
    rows = spark.range(0, 8000, 1, 8).select("id", kinds.alias("a"), (F.col("id") % 2).alias("b"))
    table = models.index_table(rows.where("id >= 4000"), ["a", "b"]).where("value <> 'v3'")
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        options = {} if frequent == models.FREQUENT else {"frequent": frequent}
        got = models.indexed_by(rows, table, ["a", "b"], **options).withColumn("_part", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    index = {(r["field"], r["value"]): r["idx"] for r in table.collect()}
    expected = [(r["id"], r["a"], r["b"], index["a", r["a"]], index["b", str(r["b"])]) for r in rows.collect() if ("a", r["a"]) in index]
    assert index["a", "hot"] == 0.0 and len(expected) == 7120
    assert sorted(tuple(r)[:5] for r in got) == sorted(expected)
    parts = [r["_part"] for r in got]
    assert max(map(parts.count, set(parts))) < len(got) / 2
