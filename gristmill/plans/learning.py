"""Splits, samples and models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gristmill.operators import models, rules, splits
from gristmill.plans import bindings as b
from gristmill.plans import logistic_sql, tree_sql
from gristmill.plans.registry import query
from gristmill.session import scratch

ORDER = ", ".join(b.LINE_ORDER)
RATING_OUT = "user_id, movie_id, rating, l_orderkey, l_linenumber"


@query(f"""
SELECT {RATING_OUT}, pos, CAST((pos - 1) // ((total + 4) // 5) + 1 AS INTEGER) AS fold FROM (
    SELECT *, row_number() OVER (ORDER BY {ORDER}) AS pos, count(*) OVER () AS total
    FROM ({b.RATINGS_SQL}))""")
def k_fold_split(spark, folder):
    folds = splits.k_folds(b.ratings(spark, folder), b.LINE_ORDER)
    return folds.select(*RATING_OUT.split(", "), "pos", "fold")


def leave_sql(start: int, stop: int, cap: int) -> str:
    hit = f"nth BETWEEN {start} AND {stop}"
    return f"""
    SELECT {RATING_OUT}, pos, {hit} AND (
               {cap} <= 0 OR sum(CASE WHEN {hit} THEN 1 ELSE 0 END) OVER (ORDER BY pos) <= {cap})
               AS is_test
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {ORDER}) AS nth,
                 row_number() OVER (ORDER BY {ORDER}) AS pos
          FROM ({b.RATINGS_SQL}))"""


@query(leave_sql(1, 10, 0))
def leave_n_split(spark, folder):
    marked = splits.leave_n(b.ratings(spark, folder), "user_id", b.LINE_ORDER, 1, 10)
    return marked.select(*RATING_OUT.split(", "), "pos", "is_test")


@query(leave_sql(11, 20, 5_000))
def leave_n_split_capped(spark, folder):
    marked = splits.leave_n(b.ratings(spark, folder), "user_id", b.LINE_ORDER, 11, 20, 5_000)
    return marked.select(*RATING_OUT.split(", "), "pos", "is_test")


@query(f"""
SELECT doc_id, url, title FROM ({b.ARTICLES_SQL})
ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 1""")
def random_row(spark, folder):
    return splits.random_row(b.articles(spark, folder), "doc_id", seed=7).select("doc_id", "url", "title")


ORDER_DIGEST = "('0x' || substr(md5('42:=' || CAST(o_orderkey AS VARCHAR)), 1, 15))::BIGINT"


@query(f"""
SELECT o_orderkey, o_custkey,
       row_number() OVER (ORDER BY {ORDER_DIGEST}, o_orderkey) > floor(count(*) OVER () * 0.9 + 0.5) AS is_test
FROM orders""")
def exact_split(spark, folder):
    """Nine tenths of the orders and the rest, of exact sizes, by the order of a digest."""
    orders = b.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    train, test = splits.exact_split(orders, "o_orderkey")
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


SHARED = '"Year", "Month", "UniqueCarrier", "Origin", "Dest", "ArrDelay", l_orderkey, l_linenumber'


@query(f"SELECT {SHARED} FROM ({b.FLIGHTS_SQL})")
def union_years(spark, folder):
    """Yearly tables as one: the table is written as one part per year, in one scan, and
    every part that is there is read as a table of its own."""
    base = scratch(spark, "years")
    whole = b.flights(spark, folder).select(*[c.strip().strip('"') for c in SHARED.split(",")])
    whole.withColumn("_part", F.col("Year")).write.partitionBy("_part").parquet(base)
    years = [r[0] for r in spark.read.parquet(base).select("_part").distinct().orderBy("_part").collect()]
    none = whole.where(F.lit(False))
    # Rows without a year have a folder of their own, under Spark's name for null.
    names = ["__HIVE_DEFAULT_PARTITION__" if y is None else y for y in years]
    parts = [spark.read.schema(whole.schema).parquet(f"{base}/_part={y}") for y in names]
    return splits.union_all(none, *parts)


ROWS_SQL = f"""
SELECT "Year", "Month", "DayofMonth", "DayOfWeek", "CRSDepTime", "CRSArrTime", "UniqueCarrier",
       TRY_CAST("CRSElapsedTime" AS INTEGER) AS "CRSElapsedTime", "Origin", "Dest", "Distance",
       "Cancelled", CAST(TRY_CAST("ArrDelay" AS DOUBLE) AS DOUBLE) AS "ArrDelay",
       CASE WHEN TRY_CAST("ArrDelay" AS DOUBLE) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
FROM ({b.FLIGHTS_SQL})
WHERE "Cancelled" = 0 AND TRY_CAST("ArrDelay" AS DOUBLE) IS NOT NULL"""


@query(ROWS_SQL)
def delay_features(spark, folder):
    return models.delay_rows(b.flights(spark, folder))


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS field, "{c}" AS value,
        CAST(row_number() OVER (ORDER BY count(*) DESC, "{c}") - 1 AS DOUBLE) AS idx
        FROM ({ROWS_SQL}) GROUP BY "{c}" """
    for c in models.CATEGORIES))
def string_index(spark, folder):
    """Every label with its index."""
    return models.index_table(models.delay_rows(b.flights(spark, folder)))


FLIGHT_KEY = ("l_orderkey", "l_linenumber")
INDEX_SQL = " ".join(
    f"""JOIN (SELECT "{c}" AS v{c}, CAST(row_number() OVER (ORDER BY count(*) DESC, "{c}") - 1 AS DOUBLE) AS "{c}_index"
        FROM flown GROUP BY "{c}") ON v{c} = "{c}" """
    for c in models.CATEGORIES
)


@query(f"""
WITH flown AS (
    SELECT l_orderkey, l_linenumber, "UniqueCarrier", "Origin", "Dest" FROM ({b.FLIGHTS_SQL})
    WHERE "Cancelled" = 0 AND TRY_CAST("ArrDelay" AS DOUBLE) IS NOT NULL)
SELECT l_orderkey, l_linenumber, {", ".join(f'"{c}_index"' for c in models.CATEGORIES)} FROM flown {INDEX_SQL}""")
def indexed_flights(spark, folder):
    """Every flight with the indexes of its labels."""
    rows = models.delay_rows(b.flights(spark, folder), keep=FLIGHT_KEY).checkpoint()
    indexed = models.indexed_by(rows, models.index_table(rows))
    return indexed.select(*FLIGHT_KEY, *[f"{c}_index" for c in models.CATEGORIES])


def _delay_split(spark, folder, keep=()):
    """Train and test rows, by a digest of their key. The rows are joined and typed once and written;
    indexes, fits and predictions read them from there."""
    key = F.concat_ws(":", F.lit("42"), *[F.col(c).cast("string") for c in FLIGHT_KEY])
    held = F.substring(F.md5(key.cast("binary")), 1, 1).isin("0", "8")
    rows = models.delay_rows(b.flights(spark, folder), keep=FLIGHT_KEY).withColumn("_held", held).checkpoint()
    dropped = [c for c in ("_held", *FLIGHT_KEY) if c not in keep]
    return rows.where(~F.col("_held")).drop(*dropped), rows.where("_held").drop(*dropped)


IN_TEST = " || ':' || ".join(f"CAST({c} AS VARCHAR)" for c in ("l_orderkey", "l_linenumber"))
TEST_SQL = f"substr(md5('42:' || {IN_TEST}), 1, 1) IN ('0', '8')"
GATE = 0.55
FOREST = {"trees": 5, "size": 6, "depth": 4, "least": 100}
# Flown rows with categories as the train rows' frequency indexes; a row without a number or
# with a category that no train row has is skipped.
INDEXED_SQL = f"""
SELECT f.* REPLACE ({", ".join(f'i{c}.idx AS "{c}"' for c in models.CATEGORIES)},
                    TRY_CAST("CRSElapsedTime" AS INTEGER) AS "CRSElapsedTime"),
       CASE WHEN TRY_CAST("ArrDelay" AS DOUBLE) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, {TEST_SQL} AS held
FROM ({b.FLIGHTS_SQL}) f {" ".join(
    f"""JOIN (SELECT "{c}", CAST(row_number() OVER (ORDER BY count(*) DESC, "{c}") - 1 AS DOUBLE) AS idx
        FROM ({b.FLIGHTS_SQL}) WHERE "Cancelled" = 0 AND TRY_CAST("ArrDelay" AS DOUBLE) IS NOT NULL AND NOT {TEST_SQL}
        GROUP BY "{c}") i{c} ON i{c}."{c}" = f."{c}" """ for c in models.CATEGORIES)}
WHERE "Cancelled" = 0 AND TRY_CAST("ArrDelay" AS DOUBLE) IS NOT NULL AND TRY_CAST("CRSElapsedTime" AS INTEGER) IS NOT NULL"""
BAG_SQL = f"substr(md5('42:' || tree || ':' || {IN_TEST}), 1, 1) < 'a'"


FOREST_SQL = tree_sql.grown(
    f"SELECT *, 0 AS row FROM ({INDEXED_SQL}) WHERE NOT held",
    f"SELECT *, row_number() OVER () AS row FROM ({INDEXED_SQL}) WHERE held",
    [*FLIGHT_KEY, "label", "row"],
    "label",
    models.feature_sets(FOREST["trees"], FOREST["size"]),
    FOREST["depth"],
    FOREST["least"],
    BAG_SQL,
) + """
SELECT l_orderkey, l_linenumber, label, string_agg(CAST(node AS VARCHAR), ',' ORDER BY tree) AS leaves,
       round(avg(value), 6) AS probability, CASE WHEN avg(value) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
FROM scored GROUP BY l_orderkey, l_linenumber, label, row"""


@query(FOREST_SQL)
def delay_forest(spark, folder):
    """Every test row with its leaf in each tree, the forest's probability and its prediction; the
    twin grows the same trees from the train rows."""
    train, test = _delay_split(spark, folder, FLIGHT_KEY)
    predicted, _ = models.subspace_forest(train, test, FLIGHT_KEY, **FOREST)
    return predicted.select(
        *FLIGHT_KEY,
        "label",
        F.array_join(F.transform("leaves", lambda x: x.cast("string")), ",").alias("leaves"),
        F.round("probability", 6).alias("probability"),
        "prediction",
    )


TRAIN_SQL = f"SELECT * FROM ({INDEXED_SQL}) WHERE NOT held"
HELD_SQL = f"SELECT *, row_number() OVER () AS row FROM ({INDEXED_SQL}) WHERE held"
LOGISTIC = logistic_sql.fitted(TRAIN_SQL, HELD_SQL, [*FLIGHT_KEY, "label"], "label", models.FEATURES)
LOGISTIC_OUT = """
SELECT l_orderkey, l_linenumber, label, array_to_string(list_transform(x, lambda v: CAST(v AS VARCHAR)), ',') AS features,
       round(probability, 4) AS probability, CASE WHEN probability > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction"""


def _logistic_out(predicted):
    values = F.transform(vector_to_array("features"), lambda v: v.cast("string"))
    return predicted.select(
        *FLIGHT_KEY,
        "label",
        F.array_join(values, ",").alias("features"),
        F.round(F.get(vector_to_array("probability"), 1), 4).alias("probability"),
        "prediction",
    )


@query(f"WITH {LOGISTIC} {LOGISTIC_OUT} FROM predicted")
def delay_logistic(spark, folder):
    """Every test row with its vector, the probability of a delay and the prediction; the twin fits
    the same model by Newton steps."""
    train, test = _delay_split(spark, folder, FLIGHT_KEY)
    return _logistic_out(models.delay_logistic(train, test, tol=1e-12, steps=500))


@query(f"""
WITH {LOGISTIC}, gate AS (
    SELECT avg(CASE WHEN label = CASE WHEN probability > 0.5 THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END) >= {GATE} AS kept
    FROM predicted
)
SELECT l_orderkey, l_linenumber, label, 'logistic' AS model, round(probability, 4) AS probability,
       CASE WHEN probability > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
FROM predicted, gate WHERE kept
UNION ALL
SELECT l_orderkey, l_linenumber, label, 'forest', round(probability, 4), prediction
FROM ({FOREST_SQL}), gate WHERE NOT kept""")
def delay_model(spark, folder):
    """The gated choice between both models: the logistic predictions, or the forest's where the
    logistic accuracy misses the gate."""
    train, test = _delay_split(spark, folder, FLIGHT_KEY)
    columns = [*FLIGHT_KEY, "label", "model", "probability", "prediction"]
    first = _logistic_out(models.delay_logistic(train, test, tol=1e-12, steps=500))
    reached = models.accuracy(first).first()["accuracy"]
    if reached is None or reached >= GATE:
        return first.withColumn("model", F.lit("logistic")).select(columns)
    forest, _ = models.subspace_forest(train, test, FLIGHT_KEY, **FOREST)
    return forest.select(
        *FLIGHT_KEY, "label", F.lit("forest").alias("model"), F.round("probability", 4).alias("probability"), "prediction"
    )


@query(f"""
SELECT avg(CASE WHEN label = CASE WHEN "Distance" > 25 THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END)
           AS accuracy, count(*) AS n
FROM ({ROWS_SQL})""")
def accuracy(spark, folder):
    """Accuracy of a fixed rule."""
    rows = models.delay_rows(b.flights(spark, folder)).withColumn(
        "prediction", (F.col("Distance") > 25).cast("double")
    )
    return models.accuracy(rows)


HOUSE_FEATURES = ("HouseAge", "DistanceToMRT", "NumberConvenienceStores")


HOUSES_SQL = """
SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS "HouseAge", CAST(p_partkey % 40 AS DOUBLE) AS "DistanceToMRT",
       length(p_name) AS "NumberConvenienceStores", p_retailprice AS "PriceOfUnitArea",
       substr(md5('42:' || CAST(p_partkey AS VARCHAR)), 1, 1) IN ('0', '8') AS held FROM part"""
PRICE_DEPTH, PRICE_LEAST = 4, 15


@query(
    tree_sql.grown(
        f"SELECT * FROM ({HOUSES_SQL}) WHERE NOT held",
        f"SELECT * FROM ({HOUSES_SQL}) WHERE held",
        ["id"],
        '"PriceOfUnitArea"',
        [HOUSE_FEATURES],
        PRICE_DEPTH,
        PRICE_LEAST,
    )
    + """
SELECT id, h."PriceOfUnitArea", node AS leaf, n AS n_train, round(value, 6) AS prediction
FROM scored JOIN part ON p_partkey = id JOIN (SELECT p_partkey AS pk, p_retailprice AS "PriceOfUnitArea" FROM part) h ON pk = id"""
)
def price_tree(spark, folder):
    """Every test row with its leaf, the leaf's train rows and their mean price; the twin grows the
    same tree from the train rows."""
    houses = b.houses(spark, folder)
    key = F.concat(F.lit("42:"), F.col("id").cast("string"))
    held = F.substring(F.md5(key.cast("binary")), 1, 1).isin("0", "8")
    train, test = houses.where(~held), houses.where(held)
    predicted, found = models.price_rules(train, test, HOUSE_FEATURES, "PriceOfUnitArea", PRICE_DEPTH, PRICE_LEAST)
    facts = rules.leaf_facts(train, found, "PriceOfUnitArea").select("leaf", F.col("n").alias("n_train"))
    return predicted.join(facts, "leaf").select(
        "id", "PriceOfUnitArea", "leaf", "n_train", F.round("prediction", 6).alias("prediction")
    )


@query("""
SELECT round(avg(abs(1000 + p_size - p_retailprice)), 4) AS mean_abs_error FROM part""")
def mean_abs_error(spark, folder):
    """Error of a fixed rule."""
    rows = b.houses(spark, folder).withColumn("prediction", 1000 + F.col("HouseAge"))
    error = models.mean_abs_error(rows, "PriceOfUnitArea")
    return error.select(F.round("mean_abs_error", 4).alias("mean_abs_error"))


@query(f"SELECT 100::BIGINT AS parts, count(*) AS n FROM ({ROWS_SQL})")
def hundred_partitions(spark, folder):
    """The flights dealt into a hundred partitions, none of them empty."""
    rows = models.delay_rows(b.flights(spark, folder), partitions=100)
    parts = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return parts.agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"))
