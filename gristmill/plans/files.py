"""The given tables written in other formats and read back by the file sources."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gristmill.operators import tables, words
from gristmill.plans import bindings as b
from gristmill.plans.registry import query
from gristmill.plans.words import LETTERS_SQL, PLAIN_SQL
from gristmill.session import scratch
from gristmill.sources import collection, readers, rolled, writers
from gristmill.streaming import runs

ARTICLE_SQL = f"""
SELECT url, title, CAST(photo_count AS BIGINT) AS photo_count, CAST(comment_count AS BIGINT) AS comment_count
FROM ({b.ARTICLES_SQL})"""


def _article_columns(df):
    return df.select(
        "url", "title", F.col("photo_count").cast("long").alias("photo_count"), F.col("comment_count").cast("long").alias("comment_count")
    )


@query(ARTICLE_SQL)
def json_lines_articles(spark, folder):
    """Articles as JSON Lines."""
    path = scratch(spark, "lines")
    writers.write_articles(b.articles(spark, folder).drop("doc_id", "category"), path)
    return _article_columns(readers.read_articles(spark, path))


@query(ARTICLE_SQL)
def json_array_articles(spark, folder):
    """Articles in files that hold one JSON array each."""
    path = scratch(spark, "arrays")
    articles = b.articles(spark, folder).drop("category")
    # Five hundred documents a file, whatever the table's size.
    arrays = articles.groupBy(F.expr("doc_id div 500")).agg(
        F.to_json(F.collect_list(F.struct(*[c for c in articles.columns if c != "doc_id"]))).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return _article_columns(readers.read_articles(spark, path, array_file=True))


@query("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer""")
def csv_with_header(spark, folder):
    """A table exported with a header and read back with inferred types."""
    path = scratch(spark, "csv")
    writers.write_csv(b.table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), path)
    found = readers.read_delimited(spark, path, header=True)
    return found.select(
        F.col("c_custkey").cast("long").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast(b.table(spark, folder, "customer").schema["c_nationkey"].dataType).alias("c_nationkey"),
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
    )


@query("""
SELECT l_orderkey AS user_id, l_partkey AS movie_id,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS rating
FROM lineitem""")
def tab_ratings_with_bad_fields(spark, folder):
    """Tab-separated ratings without a header; every third line number has a bad field, which
    becomes null."""
    path = scratch(spark, "tab")
    bad = F.when(F.col("l_linenumber") == 3, F.lit("n/a")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    rows = b.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", bad.alias("rating"))
    writers.write_csv(rows, path, header=False, sep="\t")
    return readers.read_delimited(spark, path, "user_id long, movie_id long, rating int", sep="\t")


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier")
def pipe_names(spark, folder):
    """Names separated by pipes, with columns renamed by position and a view for SQL."""
    path = scratch(spark, "pipe")
    writers.write_csv(b.table(spark, folder, "supplier").select("s_suppkey", "s_name"), path, header=False, sep="|")
    readers.read_delimited(spark, path, sep="|", names=("id", "name"), view="gristmill_names")
    return spark.sql("SELECT CAST(id AS BIGINT) AS id, name FROM gristmill_names")


def _text_files(spark, folder):
    path = scratch(spark, "text")
    b.table(spark, folder, "documents").select(F.col("text").alias("value")).write.text(path)
    return path


@query(LETTERS_SQL)
def text_file_letters(spark, folder):
    """Letters of a set of text files."""
    return words.letter_counts(readers.read_lines(spark, _text_files(spark, folder)))


@query(LETTERS_SQL)
def text_stream_letters(spark, folder):
    """Letters of a stream of text files."""
    counts = words.letter_counts(readers.text_stream(spark, path=_text_files(spark, folder)))
    base = scratch(spark, "letters")
    runs.finish(runs.write_batches(counts, f"{base}/out", f"{base}/checkpoint", "complete"))
    return runs.last_batch(spark, f"{base}/out", counts.schema)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 2 = 0")
def csv_stream_sink(spark, folder):
    """Rows of a stream appended to CSV files."""
    base = scratch(spark, "sink")
    stream = readers.table_stream(spark, f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    runs.finish(runs.to_csv(stream.where("o_custkey % 2 = 0"), f"{base}/out", f"{base}/checkpoint", every=None))
    return spark.read.schema(stream.schema).csv(f"{base}/out")


@query("SELECT replace(text, chr(10), ' ') AS line FROM documents")
def chunked_text(spark, folder):
    """Texts exported one line each, in files of a fixed number of lines."""
    path = scratch(spark, "chunks")
    writers.write_lines(b.table(spark, folder, "documents"), path, "text", writers.CHUNK)
    return readers.read_lines(spark, path).select(F.col("value").alias("line"))


@query("""
SELECT row_number() OVER (ORDER BY o_custkey, o_orderkey) AS pos, o_custkey, o_orderkey FROM orders""")
def sorted_files(spark, folder):
    """Rows written in key order over all files: the files' order is the rows' order."""
    path = scratch(spark, "sorted")
    writers.write_sorted(b.table(spark, folder, "orders").select("o_custkey", "o_orderkey"), path, "o_custkey", "o_orderkey")
    files = readers.read_delimited(spark, path, "o_custkey long, o_orderkey long", sep="\t").select(
        "*", F.col("_metadata.file_name").alias("f")
    )
    spans = files.groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    # One row per file: the rows of the files before it.
    earlier = Window.orderBy("f").rowsBetween(Window.unboundedPreceding, -1)
    before = spans.select("f", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("f").orderBy("o_custkey", "o_orderkey"))
    return files.join(before, "f").select((rank + F.col("offset")).cast("long").alias("pos"), "o_custkey", "o_orderkey")


@query("""
SELECT station || ' ' || CAST(reading AS VARCHAR) AS line FROM (
    SELECT 's' || CAST(o_custkey AS VARCHAR) AS station, max(CAST(o_orderkey AS BIGINT)) AS reading
    FROM orders GROUP BY o_custkey)""")
def text_lines_of_extremes(spark, folder):
    """One printed line per station, written as text and read back."""
    path = scratch(spark, "printed")
    orders = b.table(spark, folder, "orders")
    best = tables.total_by(
        orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("reading")).withColumn(
            "station", F.concat(F.lit("s"), F.col("o_custkey").cast("string"))
        ),
        "station",
        "reading",
        "reading",
    )
    writers.write_lines(best.select(F.concat_ws(" ", "station", F.col("reading").cast("long").cast("string")).alias("value")), path)
    return readers.read_lines(spark, path).select(F.col("value").alias("line"))



@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def rolled_stream_sink(spark, folder):
    """Rows of a stream in CSV files that end at 64 KiB or a minute, with a prefix and a suffix."""
    base = scratch(spark, "rolled")
    stream = readers.table_stream(spark, f"{folder}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")
    runs.finish(
        runs.to_rolled(
            stream, f"{base}/out", f"{base}/checkpoint", every=None, kind="csv", prefix="orders", suffix=".csv", max_bytes=1 << 16
        )
    )
    return rolled.read_rolled(spark, f"{base}/out", stream.schema)


@query(f"SELECT word || ',' || n AS line FROM ({PLAIN_SQL})")
def prefixed_word_counts(spark, folder):
    """Word counts, a line each, in files named prefix-….ext."""
    rolled.register(spark)
    path = scratch(spark, "prefixed")
    counts = words.plain_counts(b.text_lines(spark, folder))
    line = F.concat_ws(",", "word", F.col("n").cast("string")).alias("line")
    counts.select(line).write.format("rolled").mode("append").options(path=path, prefix="prefix", suffix=".ext").save()
    return rolled.read_rolled(spark, path, "value string", "text").select(F.col("value").alias("line"))


@query(f"""
SELECT CAST((pos - 1) // {writers.CHUNK} AS BIGINT) AS chunk, count(*) AS n, min(pos) AS first, max(pos) AS last,
       1::BIGINT AS files
FROM (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos FROM lineitem)
GROUP BY 1""")
def exact_chunks(spark, folder):
    """Lines in files of exactly 30 000 records over the whole table, in order."""
    path = scratch(spark, "exact")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = b.table(spark, folder, "lineitem").select(*order)
    value = F.concat_ws("|", *[F.col(c).cast("string") for c in order])
    writers.write_chunks(lines.withColumn("value", value), path, order, "value")
    files = spark.read.schema("pos bigint, value string, chunk bigint").option("sep", "\t").csv(path)
    return files.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
        F.count_distinct(F.col("_metadata.file_path")).alias("files"),
    )


@query(f"""
SELECT title, CAST(comment_count AS INTEGER) AS comment_count, lang AS first_tag FROM ({b.ARTICLES_SQL})
WHERE comment_count > 100""")
def collection_fields(spark, folder):
    """Three fields of the articles of a loaded collection: two have columns, the third is read out of
    the documents."""
    path = scratch(spark, "collection")
    whole = b.articles(spark, folder).drop("doc_id")
    texts = whole.select(F.to_json(F.struct(*whole.columns), {"ignoreNullFields": "false"}).alias("value"))
    collection.load(texts, path, {"title": "string", "comment_count": "int"})
    found = collection.Collection(spark, path)
    out = found.find("title", "comment_count", ("tags[0]", "string"), where=found.field("comment_count") > 100)
    return out.toDF("title", "comment_count", "first_tag")


@query("SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name FROM customer")
def space_names(spark, folder):
    """Names in quotes after a number and a space, read with a declared schema."""
    path = scratch(spark, "space")
    lines = b.table(spark, folder, "customer").select(F.concat(F.col("c_custkey").cast("string"), F.lit(' "'), "c_name", F.lit('"')).alias("value"))
    writers.write_lines(lines, path)
    return readers.read_delimited(spark, path, "id int, name string", sep=" ")


@query("""
SELECT 's' || CAST(o_custkey AS VARCHAR) || chr(9) || printf('%.2fC', max(CAST(o_orderkey AS DOUBLE)) * 0.1) AS line
FROM orders GROUP BY o_custkey""")
def degree_lines(spark, folder):
    """The largest reading of each station in degrees, printed with two decimals."""
    orders = b.table(spark, folder, "orders")
    lines = orders.select(
        F.concat(F.lit("s"), F.col("o_custkey").cast("string"), F.lit(",18000101,TMAX,"), F.col("o_orderkey").cast("string")).alias("value")
    )
    return tables.degree_lines(tables.extreme_by_station(tables.readings(lines), "TMAX"))


@query("""
SELECT i AS batch, count(o_orderkey) AS n
FROM range(4) r(i) LEFT JOIN orders ON o_orderkey % 4 = i GROUP BY i""")
def one_file_per_trigger(spark, folder):
    """Rows per batch of a stream that takes one file at a time, oldest first."""
    base = scratch(spark, "files")
    orders = b.table(spark, folder, "orders").select("o_orderkey")
    for i in range(4):
        orders.where(F.col("o_orderkey") % 4 == i).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    runs.finish(runs.write_batches(stream, f"{base}/out", f"{base}/checkpoint"))
    found = runs.read_batches(spark, f"{base}/out", orders.schema)
    return found.groupBy(F.col("batch_id").alias("batch")).agg(F.count("o_orderkey").alias("n"))
