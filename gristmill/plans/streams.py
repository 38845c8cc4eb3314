"""Streams over the given tables, run until all input is worked off."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gristmill.operators import words
from gristmill.operators.messages import parse_articles
from gristmill.plans import bindings as b
from gristmill.plans.registry import query
from gristmill.plans.tables import GLOBAL_LATE, KEYED_LATE
from gristmill.plans.words import LETTERS_SQL, PLAIN_SQL, WORD
from gristmill.session import scratch
from gristmill.sources.readers import table_stream
from gristmill.streaming import changelog, detector, fanout, runs, windows


def _stream(spark, folder, name):
    return table_stream(spark, f"{folder}/{name}.parquet")


def _documents(spark, folder):
    return b.spread(_stream(spark, folder, "documents"))


def _lines(spark, folder):
    return _documents(spark, folder).select(F.col("text").alias("value"))


def _write(spark, stream, label, mode, **options):
    base = scratch(spark, label)
    runs.finish(
        runs.write_batches(stream, f"{base}/out", f"{base}/checkpoint", mode, **options)
    )
    return f"{base}/out"


@query(PLAIN_SQL)
def stream_word_count(spark, folder):
    """Written unsorted; sorted once, when the newest counts are read."""
    counts = words.plain_counts(_lines(spark, folder))
    out = _write(spark, counts, "words", "complete")
    return runs.last_batch(spark, out, counts.schema).orderBy(F.col("n").desc(), F.col("word"))


@query(LETTERS_SQL)
def stream_letter_count(spark, folder):
    counts = words.letter_counts(_lines(spark, folder))
    out = _write(spark, counts, "letters", "update")
    return runs.last_per_key(spark, out, counts.schema, ["letter"])


@query(f"SELECT letter || ': ' || n AS line FROM ({LETTERS_SQL})")
def letter_log_lines(spark, folder):
    """Logged counts, one text line each."""
    counts = words.letter_counts(_lines(spark, folder))
    base = scratch(spark, "log")

    def log(batch, batch_id):
        words.log_lines(batch).write.mode("overwrite").text(
            runs.batch_path(f"{base}/out", batch_id)
        )

    runs.finish(runs.start(counts, log, f"{base}/checkpoint", "complete"))
    lines = spark.read.text(f"{base}/out")
    newest = lines.agg(F.max("batch_id")).scalar()
    return lines.where(F.col("batch_id") == newest).select(F.col("value").alias("line"))


def sliding_sql(table: str, ts: str, size: int, slide: int, keys: str, values: str) -> str:
    """Every row in each of the size/slide windows (seconds) that hold it."""
    return f"""
    SELECT window_start, window_start + INTERVAL {size} SECOND AS window_end, {keys}{values}
    FROM (SELECT *, time_bucket(INTERVAL {slide} SECOND, {ts})
                    - to_seconds(CAST(k * {slide} AS BIGINT)) AS window_start
          FROM {table}, range({size // slide}) r(k))
    GROUP BY {keys}window_start"""


@query(sliding_sql("(SELECT ts, event_type AS word FROM events)", "ts", 30, 15, "word, ",
                   "count(*) AS n"))
def sliding_word_count(spark, folder):
    lines = windows.with_event_time(
        _stream(spark, folder, "events").select("ts", F.col("event_type").alias("value")),
        "ts",
        late=None,
    )
    counts = windows.word_windows(windows.timed_words(lines))
    out = _write(spark, counts, "windows", "complete", order=windows.word_order())
    return runs.last_batch(spark, out, counts.schema)


KEYWORD_WINDOWS = sliding_sql(
    "events", "ts", 3600, 600, "",
    "count(*) AS total_count, CAST(sum(CAST(contains(event_type, 'error') AS INTEGER)) AS BIGINT)"
    " AS keyword_count")


@query(KEYWORD_WINDOWS)
def sliding_keyword_count_complete(spark, folder):
    """All windows, those still open at the end too."""
    events = windows.with_event_time(_stream(spark, folder, "events"), "ts", late=None)
    counts = windows.keyword_windows(
        events, F.col("event_type").contains("error"), "1 hour", "10 minutes"
    )
    out = _write(spark, counts, "keywords", "complete")
    return runs.last_batch(spark, out, counts.schema)


@query(f"""
SELECT * FROM ({sliding_sql("events", "ts", 3600, 600, "",
    "count(*) AS total_count, CAST(sum(CAST(contains(event_type, 'error') AS INTEGER)) AS BIGINT)"
    " AS keyword_count")})
WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) FROM events)""")
def sliding_keyword_count(spark, folder):
    """Finished windows only: a window is written once the watermark passes it."""
    events = windows.with_event_time(_stream(spark, folder, "events"), "ts")
    counts = windows.keyword_windows(
        events, F.col("event_type").contains("error"), "1 hour", "10 minutes"
    )
    out = _write(spark, counts, "keywords", "append")
    return runs.read_batches(spark, out, counts.schema).drop("batch_id")


@query(b.PARSED_SQL)
def parse_events(spark, folder):
    return parse_articles(b.messages(b.texts(spark, folder, "documents")), "doc_id")


def _parsed_stream(spark, folder):
    return parse_articles(b.messages(_documents(spark, folder)), "doc_id")


@query(f"SELECT doc_id, title, comment_count FROM ({b.PARSED_SQL}) WHERE comment_count > 100")
def stream_alerts(spark, folder):
    found = fanout.alerts(_parsed_stream(spark, folder)).select("doc_id", "title", "comment_count")
    out = _write(spark, found, "alerts", "append")
    return runs.read_batches(spark, out, found.schema).drop("batch_id")


@query(f"""
SELECT 'titles' AS branch, doc_id, NULL::INTEGER AS comment_count, title FROM ({b.PARSED_SQL})
UNION ALL SELECT 'alerts', doc_id, comment_count, title FROM ({b.PARSED_SQL})
          WHERE comment_count > 100
UNION ALL SELECT 'keyword', doc_id, comment_count, NULL FROM ({b.PARSED_SQL})
          WHERE contains(content, '{b.STREAM_WORD}')
UNION ALL SELECT 'all', doc_id, comment_count, content FROM ({b.PARSED_SQL})""")
def stream_fan_out(spark, folder):
    """Four sinks fed by one stream, read back and put together."""
    base = scratch(spark, "fan")
    none = F.lit(None)
    branches = {
        "titles": fanout.Branch(
            lambda d: d.select("doc_id", none.cast("int").alias("comment_count"), "title"),
            "parquet",
        ),
        "alerts": fanout.Branch(
            lambda d: fanout.alerts(d).select("doc_id", "comment_count", "title"), "parquet"
        ),
        "keyword": fanout.Branch(
            lambda d: d.where(F.col("content").contains(b.STREAM_WORD)).select(
                "doc_id", "comment_count", none.cast("string").alias("title")
            ),
            "parquet",
        ),
        "all": fanout.Branch(
            lambda d: d.select("doc_id", "comment_count", F.col("content").alias("title")),
            "parquet",
        ),
    }
    runs.finish(
        fanout.fan_out(_parsed_stream(spark, folder), branches, f"{base}/out", f"{base}/checkpoint")
    )
    read = spark.read.schema("doc_id long, comment_count int, title string")
    parts = [
        read.parquet(f"{base}/out/{name}").select(F.lit(name).alias("branch"), "doc_id", "comment_count", "title")
        for name in branches
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


#: Micro-batches of the registered runs in stretches.
BATCHES = 4
#: Bytes of a row group of stretches of texts: a stretch comes from few tasks and is read by all.
PART_BYTES = 4 << 20


def _cuts(rows, key):
    """Numbers that cut the rows into ``BATCHES`` stretches of about the same size."""
    shares = [i / BATCHES for i in range(1, BATCHES)]
    return rows.select(F.percentile_approx(key, shares, 10_000).alias("at")).first()["at"] or []


def _stretches(rows, key):
    """The rows in stretches of their numbers; those without a number come first."""
    bounds = [None, *_cuts(rows, key), None]
    for low, high in itertools.pairwise(bounds):
        part = F.lit(True) if low is None else F.col(key) >= low
        if high is not None:
            below = F.col(key) < high
            part = part & (below | F.col(key).isNull() if low is None else below)
        yield rows.where(part)


def _late_by_batches(spark, folder, keys=()):
    """The orders as a source written in sequence: one folder per stretch of order numbers,
    each worked off by a run of its own that goes on from the state of the run before."""
    orders = b.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    base = scratch(spark, "late")
    for rows in _stretches(orders, "o_orderkey"):
        rows.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(orders.schema).parquet(f"{base}/in")
        runs.finish(
            detector.by_batches(
                stream,
                "o_orderkey",
                "o_orderdate",
                f"{base}/out",
                f"{base}/carry",
                f"{base}/checkpoint",
                keys=keys,
            )
        )
    schema = StructType([*orders.schema.fields]).add("prev_ts", "timestamp_ntz")
    return runs.read_batches(spark, f"{base}/out", schema).drop("batch_id")


@query(KEYED_LATE)
def stream_out_of_order(spark, folder):
    return _late_by_batches(spark, folder, ["o_custkey"])


@query(GLOBAL_LATE)
def stream_out_of_order_global(spark, folder):
    return _late_by_batches(spark, folder)


@query(KEYED_LATE)
def stream_out_of_order_reordered(spark, folder):
    """The orders of a source that mixes neighbouring stretches: a row is up to an eighth of all
    numbers late, across batches. The buffer puts them back in order before the comparison."""
    orders = b.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    base = scratch(spark, "reordered")
    ends = orders.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")).first()
    delay = (ends["high"] - ends["low"]) // (2 * BATCHES) + 1 if ends["low"] is not None else 1
    # A digest of the number says how late a row comes; the batches follow the time of coming.
    comes = F.col("o_orderkey") + F.pmod(F.xxhash64(F.col("o_orderkey")), F.lit(delay))
    arrived = orders.withColumn("_comes", comes)
    late = {"seq": "o_orderkey", "ts": "o_orderdate", "keys": ["o_custkey"]}
    places = {"path": f"{base}/out", "carry": f"{base}/carry"}
    batches = 0
    for rows in _stretches(arrived, "_comes"):
        rows.drop("_comes").write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(orders.schema).parquet(f"{base}/in")
        run = detector.by_reordered_batches(stream, delay=delay, checkpoint=f"{base}/checkpoint", **late, **places)
        runs.finish(run)
        batches = runs.batches_done(run)
    detector.flush_reordered(spark, orders.schema, batch_id=batches, **late, **places)
    schema = StructType([*orders.schema.fields]).add("prev_ts", "timestamp_ntz")
    return runs.read_batches(spark, f"{base}/out", schema).drop("batch_id")


LETTER_CHANGES = f"""
SELECT doc_id, pos, substr(word, 1, 1) AS letter,
       row_number() OVER (PARTITION BY substr(word, 1, 1) ORDER BY doc_id, pos) AS n
FROM (SELECT doc_id, unnest(l) AS word, CAST(generate_subscripts(l, 1) AS INTEGER) AS pos
      FROM (SELECT doc_id, string_split_regex(lower(text), '[^{WORD}]+') AS l FROM documents))
WHERE regexp_full_match(word, '[a-z]+')"""


@query(LETTER_CHANGES)
def stream_letter_changes(spark, folder):
    """The running count of a word's first letter after each word, over several batches."""
    documents = b.table(spark, folder, "documents").select("doc_id", "text")
    base = scratch(spark, "changes")
    schema = StructType().add("doc_id", "long").add("pos", "integer").add("letter", "string").add("n", "long")
    for rows in _stretches(documents, "doc_id"):
        rows.write.mode("append").option("parquet.block.size", PART_BYTES).parquet(f"{base}/in")
        stream = b.spread(spark.readStream.schema(documents.schema).parquet(f"{base}/in"))
        letters = words.letter_events(stream, "doc_id", "text")
        runs.finish(
            changelog.by_batches(
                letters, ["letter"], ["doc_id", "pos"], f"{base}/out", f"{base}/carry", f"{base}/checkpoint"
            )
        )
    return runs.read_batches(spark, f"{base}/out", schema).drop("batch_id")
