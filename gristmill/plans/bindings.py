"""The given tables as the records the operators expect.

Each binding has its SQL twin beside it (``*_SQL``). Parameters the data forces,
such as years and keywords, are at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Session setting: into how many tasks texts are dealt before work on them. Unset, the
#: scan decides; tables of one row group gain from a number of about the cores.
TEXT_PARTITIONS = "spark.gristmill.text.partitions"


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows if the session asks for it."""
    wanted = df.sparkSession.conf.get(TEXT_PARTITIONS, None)
    return df.repartition(int(wanted)) if wanted else df


def texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of long texts, ready for work on every core."""
    return spread(table(spark, folder, name))


# --- articles -------------------------------------------------------------

ARTICLES_SQL = """
SELECT d.doc_id,
       'https://example.com/' || sha256(d.text) AS url,
       split_part(d.text, chr(10), 1) AS title,
       replace(d.text, chr(10), ' ') AS body,
       d.text AS text, d.lang AS lang, d.source AS category,
       CAST(d.n_chars % 17 AS INTEGER) AS photo_count,
       CAST(d.n_chars % 251 AS INTEGER) AS comment_count
FROM documents d
"""

TIMED_ARTICLES_SQL = f"""
SELECT a.*, o.o_orderdate AS published
FROM ({ARTICLES_SQL}) a JOIN orders o ON a.doc_id = o.o_orderkey
"""


def articles(spark: SparkSession, folder: str, timed: bool = False) -> DataFrame:
    """Documents as articles; ``timed`` adds the time text from the order of the
    same number. The digest of the text stands for the address."""
    docs = texts(spark, folder, "documents")
    if timed:
        orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
        docs = docs.join(orders, docs["doc_id"] == orders["o_orderkey"])
        time = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    else:
        time = F.lit(None).cast("string")
    return docs.select(
        "doc_id",
        F.concat(F.lit("https://example.com/"), F.sha2("text", 256)).alias("url"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.split("text", "\n").alias("content"),
        F.array("lang", "source").alias("tags"),
        (F.col("n_chars") % 17).cast("int").alias("photo_count"),
        time.alias("time"),
        (F.col("n_chars") % 251).cast("int").alias("comment_count"),
        F.col("source").alias("category"),
    )


def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    return texts(spark, folder, "documents").select(F.col("text").alias("value"))


# --- article messages -----------------------------------------------------

MESSAGES_SQL = """
SELECT d.doc_id,
       d.doc_id % 7 = 6 AS broken,
       split_part(d.text, chr(10), 1) AS title,
       CAST(d.n_chars % 251 AS INTEGER) AS comment_count,
       TIMESTAMP '2000-01-01 00:00:00' + to_seconds(CAST(d.doc_id * 37 AS BIGINT))
           AS publish_ts,
       CASE WHEN d.doc_id % 2 = 0 THEN d.text ELSE replace(d.text, chr(10), ' ') END
           AS content
FROM documents d
"""

PARSED_SQL = f"""
SELECT doc_id,
       CASE WHEN broken THEN '' ELSE title END AS title,
       CASE WHEN broken THEN 0 ELSE comment_count END AS comment_count,
       CASE WHEN broken THEN NULL ELSE publish_ts END AS publish_ts,
       CASE WHEN broken THEN '' ELSE content END AS content
FROM ({MESSAGES_SQL})
"""


def messages(documents: DataFrame) -> DataFrame:
    """Documents as JSON messages ``doc_id, value``: both key spellings, content as
    text or as a list, and every seventh one cut short."""
    second = F.lit("2000-01-01T00:00:00").cast("timestamp_ntz")
    moment = F.date_format(
        second + F.make_dt_interval(secs=(F.col("doc_id") * 37).cast("decimal(18,6)")),
        "yyyy-MM-dd'T'HH:mm:ss",
    )
    count = (F.col("n_chars") % 251).cast("int")
    title = F.substring_index("text", "\n", 1).alias("title")
    plain = F.to_json(
        F.struct(
            title,
            count.alias("comment_count"),
            moment.alias("datePublished"),
            F.col("text").alias("content"),
        )
    )
    listed = F.to_json(
        F.struct(
            title,
            count.alias("commentCount"),
            moment.alias("time"),
            F.split("text", "\n").alias("content"),
        )
    )
    whole = F.when(F.col("doc_id") % 2 == 0, plain).otherwise(listed)
    cut = F.substring(whole, F.lit(1), F.length(whole) - 1)
    return documents.select(
        "doc_id", F.when(F.col("doc_id") % 7 == 6, cut).otherwise(whole).alias("value")
    )


# --- ratings, movies, spend, readings, friends -----------------------------

LINE_ORDER = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
)

RATINGS_SQL = f"""
SELECT o.o_custkey AS user_id, l.l_partkey AS movie_id,
       CAST(l.l_quantity AS INTEGER) % 5 + 1 AS rating, o.o_orderdate AS ts,
       {", ".join("l." + c for c in LINE_ORDER)}
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""


def ordered_lines(
    spark: SparkSession, folder: str, lines: DataFrame | None = None
) -> DataFrame:
    """Lines with the columns of their order."""
    lines = table(spark, folder, "lineitem") if lines is None else lines
    orders = table(spark, folder, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings with the columns that fix their order."""
    return ordered_lines(spark, folder).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        (F.col("l_quantity").cast("int") % 5 + 1).alias("rating"),
        F.col("o_orderdate").alias("ts"),
        *LINE_ORDER,
    )


VOTES_SQL = """
SELECT l_partkey AS movie_id, CAST(l_quantity AS INTEGER) % 5 + 1 AS rating FROM lineitem
"""


def votes(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings without their users: no join with the orders."""
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("movie_id"),
        (F.col("l_quantity").cast("int") % 5 + 1).alias("rating"),
    )


def rating_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Tab-separated rating records."""
    return table(spark, folder, "lineitem").select(
        F.concat_ws(
            "\t",
            F.col("l_orderkey").cast("string"),
            F.col("l_partkey").cast("string"),
            (F.col("l_quantity").cast("int") % 5 + 1).cast("string"),
            F.col("l_linenumber").cast("string"),
        ).alias("value")
    )


def movies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title")
    )


SPEND_SQL = """
SELECT o.o_custkey AS customer_id, l.l_extendedprice AS amount
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""


def spend(spark: SparkSession, folder: str) -> DataFrame:
    return ordered_lines(spark, folder).select(
        F.col("o_custkey").alias("customer_id"), F.col("l_extendedprice").alias("amount")
    )


def reading_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Comma-separated weather records."""
    return table(spark, folder, "events").select(
        F.concat_ws(
            ",",
            F.col("user_id").cast("string"),
            F.date_format("ts", "yyyyMMdd"),
            F.upper("event_type"),
            F.col("value").cast("string"),
        ).alias("value")
    )


def friends(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("age"), F.floor("c_acctbal").alias("friends")
    )


# --- adjacency lines --------------------------------------------------------

ADJACENCY_SQL = """
SELECT CAST(n_chars % 251 AS VARCHAR) || ' ' || replace(text, chr(10), ' ')
       || CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE '' END AS value
FROM documents
"""
HERO_SQL = "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer"


def adjacency(spark: SparkSession, folder: str) -> DataFrame:
    """One line per document: an id that repeats, then its words as neighbours;
    every third line ends in a space."""
    return texts(spark, folder, "documents").select(
        F.concat(
            (F.col("n_chars") % 251).cast("string"),
            F.lit(" "),
            F.replace("text", F.lit("\n"), F.lit(" ")),
            F.when(F.col("doc_id") % 3 == 0, " ").otherwise(""),
        ).alias("value")
    )


def heroes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name")
    )


# --- graph ------------------------------------------------------------------

GRAPH_SQL = """
persons AS (
    SELECT c_custkey * 2 AS id, c_name AS name,
           CAST(1940 + c_custkey % 60 AS INTEGER) AS born, c_nationkey AS nation
    FROM customer),
movies AS (
    SELECT p_partkey * 2 + 1 AS id, p_name AS title,
           CAST(1990 + p_size AS INTEGER) AS released
    FROM part),
acted AS (
    SELECT o_custkey * 2 AS src, l_partkey * 2 + 1 AS dst,
           round(l_extendedprice * 200) AS earnings
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
viewed AS (
    SELECT o_custkey * 2 AS src, l_partkey * 2 + 1 AS dst, count(*) AS views
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag = 'R' GROUP BY 1, 2)
"""


def nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as persons (even ids), parts as movies (odd ids)."""
    people = table(spark, folder, "customer").select(
        (F.col("c_custkey") * 2).alias("id"),
        F.array(F.lit("Person")).alias("labels"),
        F.col("c_name").alias("name"),
        (1940 + F.col("c_custkey") % 60).cast("int").alias("born"),
        F.lit(None).cast("string").alias("birthplace"),
    )
    films = table(spark, folder, "part").select(
        (F.col("p_partkey") * 2 + 1).alias("id"),
        F.array(F.lit("Movie")).alias("labels"),
        F.col("p_name").alias("title"),
        (1990 + F.col("p_size")).cast("int").alias("released"),
        F.lit(None).cast("string").alias("tagline"),
    )
    return people.unionByName(films, allowMissingColumns=True)


def acted_in(spark: SparkSession, folder: str) -> DataFrame:
    return ordered_lines(spark, folder).select(
        (F.col("o_custkey") * 2).alias("src"),
        (F.col("l_partkey") * 2 + 1).alias("dst"),
        F.lit("ACTED_IN").alias("type"),
        F.round(F.col("l_extendedprice") * 200).alias("earnings"),
    )


def viewed(spark: SparkSession, folder: str) -> DataFrame:
    """Returned lines as views, one edge per customer and part."""
    return (
        ordered_lines(spark, folder)
        .where(F.col("l_returnflag") == "R")
        .groupBy(
            (F.col("o_custkey") * 2).alias("src"), (F.col("l_partkey") * 2 + 1).alias("dst")
        )
        .agg(F.count(F.lit(1)).alias("views"))
        .select("src", "dst", F.lit("VIEWED").alias("type"), "views")
    )


def contacts_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """HAS_CONTACT edges of one person: everyone else of the same nation."""
    people = table(spark, folder, "customer")
    anchor = people.where(F.col("c_name") == name).select(
        F.col("c_custkey").alias("a"), F.col("c_nationkey")
    )
    return (
        people.join(anchor, "c_nationkey")
        .where(F.col("a") != F.col("c_custkey"))
        .select(
            (F.col("a") * 2).alias("src"),
            (F.col("c_custkey") * 2).alias("dst"),
            F.lit("HAS_CONTACT").alias("type"),
        )
    )


# --- flights, houses ----------------------------------------------------------

FLIGHTS_SQL = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS "Year",
       CAST(month(l_shipdate) AS INTEGER) AS "Month",
       CAST(day(l_shipdate) AS INTEGER) AS "DayofMonth",
       CAST(isodow(l_shipdate) AS INTEGER) AS "DayOfWeek",
       CAST(l_orderkey % 24 * 100 AS INTEGER) AS "CRSDepTime",
       CAST(l_partkey % 24 * 100 AS INTEGER) AS "CRSArrTime",
       l_returnflag AS "UniqueCarrier",
       CASE WHEN l_orderkey % 97 = 0 THEN 'NA'
            ELSE CAST(l_linenumber * 10 AS VARCHAR) END AS "CRSElapsedTime",
       ns.n_name AS "Origin", nc.n_name AS "Dest",
       l_quantity AS "Distance",
       CASE WHEN l_orderkey % 50 = 0 THEN 1 ELSE 0 END AS "Cancelled",
       CASE WHEN l_orderkey % 89 = 0 THEN 'NA'
            ELSE CAST(date_diff('day', o_orderdate, l_shipdate) - 60 AS VARCHAR) END
           AS "ArrDelay",
       l_orderkey, l_linenumber
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ns ON s_nationkey = ns.n_nationkey
JOIN nation nc ON c_nationkey = nc.n_nationkey
"""


def flights(
    spark: SparkSession, folder: str, lines: DataFrame | None = None
) -> DataFrame:
    """All lines as flights, or the given ones."""
    lines = ordered_lines(spark, folder, lines)
    nation = table(spark, folder, "nation")
    origin = (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_name").alias("Origin"))
    )
    dest = (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("Dest"))
    )
    order, ship = F.col("l_orderkey"), F.col("l_shipdate")
    delay = F.date_diff("l_shipdate", "o_orderdate") - 60
    return (
        lines.join(origin, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(dest, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.year(ship).alias("Year"),
            F.month(ship).alias("Month"),
            F.day(ship).alias("DayofMonth"),
            (F.weekday(ship) + 1).alias("DayOfWeek"),
            (order % 24 * 100).cast("int").alias("CRSDepTime"),
            (F.col("l_partkey") % 24 * 100).cast("int").alias("CRSArrTime"),
            F.col("l_returnflag").alias("UniqueCarrier"),
            F.when(order % 97 == 0, "NA")
            .otherwise((F.col("l_linenumber") * 10).cast("string"))
            .alias("CRSElapsedTime"),
            "Origin",
            "Dest",
            F.col("l_quantity").alias("Distance"),
            F.when(order % 50 == 0, 1).otherwise(0).alias("Cancelled"),
            F.when(order % 89 == 0, "NA").otherwise(delay.cast("string")).alias("ArrDelay"),
            *LINE_ORDER,
        )
    )


def houses(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_size").cast("double").alias("HouseAge"),
        (F.col("p_partkey") % 40).cast("double").alias("DistanceToMRT"),
        F.length("p_name").alias("NumberConvenienceStores"),
        F.col("p_retailprice").alias("PriceOfUnitArea"),
    )


# --- parameters the data forces ---------------------------------------------

YEAR = 2000
KEYWORDS = ("thatin", "ononst")
MENTIONS = ("that", "that-in", "that in")
STREAM_WORD = "thatin"
SITE = "example.com"
MOVIE = "cold gizmo"
PERSON, SECOND_PERSON = "Customer#000000277", "Customer#000000299"
BORN, ROLE_EARNINGS, TOTAL_EARNINGS = 1960, 10_000_000, 400_000_000
