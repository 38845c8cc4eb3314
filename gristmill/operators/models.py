"""Delay classifier and price regressor with ``pyspark.ml``."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators import rules
from gristmill.operators.order import with_position

# The columns of a flight and those used as features.
FLIGHT_COLUMNS = (
    "Year",
    "Month",
    "DayofMonth",
    "DayOfWeek",
    "CRSDepTime",
    "CRSArrTime",
    "UniqueCarrier",
    "CRSElapsedTime",
    "Origin",
    "Dest",
    "Distance",
    "Cancelled",
    "ArrDelay",
)
CATEGORIES = ("UniqueCarrier", "Origin", "Dest")
FEATURES = FLIGHT_COLUMNS[:11]
#: Thresholds a tree tries per feature, and one: every value is told apart up to that many.
BINS = 64
#: Values of a column whose indexes are broadcast; any other value has at most one in so many rows.
FREQUENT = 10_000


def delay_rows(flights: DataFrame, partitions: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Flown rows with a readable delay, the label and typed numbers. Numbers given
    as text are read leniently; an unreadable delay drops the row. ``keep`` names columns
    that stay beside those of a flight."""
    rows = (
        flights.select(*keep, *FLIGHT_COLUMNS)
        .withColumn("ArrDelay", F.col("ArrDelay").try_cast("double"))
        .where((F.col("Cancelled") == 0) & F.col("ArrDelay").isNotNull())
        .withColumn("label", F.when(F.col("ArrDelay") > 0, 1.0).otherwise(0.0))
        .withColumn("CRSElapsedTime", F.col("CRSElapsedTime").try_cast("int"))
    )
    return rows.repartition(partitions) if partitions else rows


def index_strings(rows: DataFrame, columns: Sequence[str] = CATEGORIES) -> PipelineModel:
    """Fit frequency indexes of all columns in one pass; the label lists are as
    long as the categories."""
    indexer = StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        handleInvalid="skip",
    )
    return Pipeline(stages=[indexer]).fit(rows)


def index_table(rows: DataFrame, columns: Sequence[str] = CATEGORIES) -> DataFrame:
    """``field``, ``value``, ``idx``: the frequency index of every value of the columns, the most frequent
    first, ties by value. A table like any other: values are counted, ranked by one range
    sort and never collected, however many there are. Nulls have no index."""
    values = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]
    counted = rows.select(F.inline(F.array(*values))).where("value IS NOT NULL")
    ranks = counted.groupBy("field", "value").agg((-F.count(F.lit(1))).alias("_less"))
    placed = with_position(ranks, ["field", "_less", "value"], "_pos")
    # One row per column.
    first = placed.groupBy("field").agg(F.min("_pos").alias("_first"))
    return placed.join(F.broadcast(first), "field").select(
        "field", "value", (F.col("_pos") - F.col("_first")).cast("double").alias("idx")
    )


def indexed_by(
    rows: DataFrame, table: DataFrame, columns: Sequence[str] = CATEGORIES, frequent: int = FREQUENT
) -> DataFrame:
    """Add ``<column>_index`` from a table of ``index_table``; rows with a value it lacks go.

    The ``frequent`` first values of a column are broadcast, so that no task gets all rows of a
    common one. A column with more values looks up the others in a shuffle join, in which the rows
    that have their index are spread by the partition they come from. The sizes that tell
    are one row per column."""
    sizes = dict(table.groupBy("field").count().collect())
    for c in columns:
        index, value = f"{c}_index", F.col(c).cast("string")
        own = table.where(F.col("field") == c).select(F.col("value").alias("_value"), F.col("idx").alias(index))
        if sizes.get(c, 0) <= frequent:
            rows = rows.join(F.broadcast(own), value == F.col("_value")).drop("_value")
            continue
        first, rest = own.where(F.col(index) < frequent), own.where(F.col(index) >= frequent)
        known = rows.where(F.col(c).isNotNull()).join(F.broadcast(first), value == F.col("_value"), "left").drop("_value")
        ask = F.when(F.col(index).isNull(), F.concat(F.lit("="), value))
        asked = known.withColumn("_ask", F.coalesce(ask, F.concat(F.lit("#"), F.spark_partition_id())))
        rare = rest.select(F.concat(F.lit("="), "_value").alias("_ask"), F.col(index).alias("_rare"))
        found = asked.join(rare, "_ask", "left").withColumn(index, F.coalesce(index, "_rare"))
        rows = found.where(F.col(index).isNotNull()).drop("_ask", "_rare")
    return rows


def assemble(rows: DataFrame, columns: Sequence[str], invalid: str = "skip") -> DataFrame:
    return VectorAssembler(
        inputCols=list(columns), outputCol="features", handleInvalid=invalid
    ).transform(rows)


def _features() -> list[str]:
    return [f"{c}_index" if c in CATEGORIES else c for c in FEATURES]


def _prepared(train: DataFrame, test: DataFrame):
    indexes = index_strings(train)
    most = max(len(labels) for labels in indexes.stages[0].labelsArray)
    ready = [assemble(indexes.transform(df), _features()) for df in (train, test)]
    return *ready, most


def _fit(estimator, rows: DataFrame, target: str = "label"):
    """Training reads its rows several times; keep them, on disk if need be."""
    rows = rows.select("features", target).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(rows)
    finally:
        rows.unpersist()


def delay_logistic(train: DataFrame, test: DataFrame, tol: float = 1e-6, steps: int = 100) -> DataFrame:
    """Predictions for the test rows; everything is fitted on the train rows."""
    return logistic_model(train, test, tol, steps)[0]


def logistic_model(
    train: DataFrame, test: DataFrame, tol: float = 1e-6, steps: int = 100
) -> tuple[DataFrame, DataFrame, LogisticRegressionModel]:
    """The predictions, the assembled train rows and the model. ``tol`` and ``steps`` end the fit."""
    fit_on, apply_to, _ = _prepared(train, test)
    fit = LogisticRegression(featuresCol="features", labelCol="label", tol=tol, maxIter=steps)
    model = _fit(fit, fit_on)
    return model.transform(apply_to), fit_on, model


def logistic_gradient(rows: DataFrame, model: LogisticRegressionModel) -> list[float]:
    """The gradient of the mean log loss at the model, intercept first, each entry divided by the
    feature's spread: 0 at the best fit. One aggregate over the assembled rows."""
    margin = F.aggregate(
        F.zip_with(F.col("x"), F.lit(model.coefficients.toArray().tolist()), lambda a, b: a * b),
        F.lit(float(model.intercept)),
        lambda s, v: s + v,
    )
    plain = rows.select("label", vector_to_array("features").alias("x"))
    miss = 1 / (1 + F.exp(-margin)) - F.col("label")
    out = plain.select("x", miss.alias("miss")).agg(
        F.avg("miss"),
        *[
            F.try_divide(F.avg(F.get("x", i) * F.col("miss")), F.nullif(F.stddev_samp(F.get("x", i)), F.lit(0.0)))
            for i in range(model.numFeatures)
        ],
    )
    return [v or 0.0 for v in out.first()]


def delay_forest(train: DataFrame, test: DataFrame, seed: int = 42) -> DataFrame:
    """As ``delay_logistic`` with a forest; bins cover the largest category."""
    fit_on, apply_to, most = _prepared(train, test)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", maxBins=max(32, most), seed=seed
    )
    return _fit(forest, fit_on).transform(apply_to)


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of right predictions, as one row."""
    right = (F.col(label) == F.col(prediction)).cast("double")
    return predictions.agg(F.avg(right).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def delay_model(train: DataFrame, test: DataFrame, gate: float = 0.55) -> DataFrame:
    """Logistic predictions, or the forest's where their accuracy misses the gate."""
    predictions = delay_logistic(train, test)
    reached = accuracy(predictions).first()["accuracy"]
    if reached is None or reached >= gate:
        return predictions.withColumn("model", F.lit("logistic"))
    return delay_forest(train, test).withColumn("model", F.lit("forest"))


def price_tree(
    train: DataFrame, test: DataFrame, features: Sequence[str], target: str
) -> DataFrame:
    """Decision-tree predictions; a row with a missing feature is an error."""
    tree = DecisionTreeRegressor(labelCol=target, featuresCol="features")
    model = tree.fit(assemble(train, features, "error"))
    return model.transform(assemble(test, features, "error"))


def price_rules(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    target: str,
    depth: int = 5,
    least: int = 1,
) -> tuple[DataFrame, list[dict]]:
    """Test rows with the ``leaf`` they fall into and its mean as ``prediction``, and the tree's
    rules. Rows are scored by the rules, not by the model."""
    tree = DecisionTreeRegressor(
        labelCol=target, featuresCol="features", maxDepth=depth, minInstancesPerNode=least, maxBins=BINS
    )
    found = rules.rule_rows(rules.saved_nodes(_fit(tree, assemble(train, features, "error"), target)), features)
    leaf = rules.with_leaves(test, found, "_leaves")
    value = F.get(rules.values_of(found, F.col("_leaves")), 0)
    return leaf.withColumn("leaf", F.get("_leaves", 0)).withColumn("prediction", value).drop("_leaves"), found


def in_bag(tree: int, key: Sequence[str], seed: int = 42) -> Column:
    """Whether a tree is fitted on a row: ten of sixteen rows, by a digest of tree and key."""
    text = F.concat_ws(":", F.lit(f"{seed}:{tree}"), *[F.col(k).cast("string") for k in key])
    return F.substring(F.md5(text.cast("binary")), 1, 1) < "a"


def feature_sets(trees: int, size: int, seed: int = 42) -> list[list[str]]:
    """The features of each tree of a subspace forest, in the order of ``FEATURES``."""
    draw = random.Random(seed)
    return [sorted(draw.sample(FEATURES, size), key=FEATURES.index) for _ in range(trees)]


def subspace_forest(
    train: DataFrame,
    test: DataFrame,
    key: Sequence[str],
    trees: int = 5,
    size: int = 6,
    depth: int = 4,
    least: int = 100,
    seed: int = 42,
) -> tuple[DataFrame, list[dict]]:
    """Test rows with ``leaves`` (one per tree), ``probability`` of a delay and ``prediction``, and
    the rules of all trees.

    Each tree sees the rows and features that a digest and a seed give it, so that the same
    forest comes out however the rows are partitioned. Its leaves hold the share of delayed
    rows; the forest's probability is their mean. Categories count by their frequency index.
    """
    indexes = index_strings(train)

    def numbers(rows: DataFrame) -> DataFrame:
        """Features as plain numbers; rows without one are skipped."""
        indexed = indexes.transform(rows)
        values = [F.col(n).cast("double").alias(c, metadata={}) for c, n in zip(FEATURES, _features(), strict=True)]
        return indexed.select(*key, "label", *values).dropna(subset=list(FEATURES))

    fit_on, found = numbers(train).persist(StorageLevel.DISK_ONLY), []
    try:
        for i, names in enumerate(feature_sets(trees, size, seed)):
            tree = DecisionTreeRegressor(labelCol="label", maxDepth=depth, minInstancesPerNode=least, maxBins=BINS)
            model = _fit(tree, assemble(fit_on.where(in_bag(i, key, seed)), names))
            found += [rule | {"tree": i} for rule in rules.rule_rows(rules.saved_nodes(model), names)]
    finally:
        fit_on.unpersist()
    scored = rules.with_leaves(numbers(test), found)
    votes = rules.mean_of(rules.values_of(found, F.col("leaves")), trees)
    out = scored.withColumn("probability", votes)
    return out.withColumn("prediction", (F.col("probability") > 0.5).cast("double")), found


def differences(predictions: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    return predictions.withColumn("difference", F.abs(F.col(prediction) - F.col(target)))


def mean_abs_error(predictions: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    return differences(predictions, target, prediction).agg(
        F.avg("difference").alias("mean_abs_error")
    )
