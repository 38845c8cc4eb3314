from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gristmill.operators import order, words
from gristmill.operators.messages import parse_articles
from gristmill.plans import streams
from gristmill.sources.readers import table_stream, text_stream
from gristmill.streaming import detector, fanout, runs, windows
from gristmill.streaming.articles import start_articles

LIMIT = 120


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def put(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{r}\n" for r in rows), encoding="utf-8")


@pytest.fixture
def book(tmp_path):
    put(tmp_path / "in", "a.txt", "To be, or not", "  to be")
    put(tmp_path / "in", "b.txt", "be 2", "")
    put(tmp_path / "in", "c.txt", "Ophelia! or")
    return tmp_path


def test_running_word_count_equals_batch(spark, book):
    stream = text_stream(spark, path=str(book / "in"), files_per_trigger=1)
    counts = words.plain_counts(stream)
    out = str(book / "out")
    query = runs.write_batches(counts, out, str(book / "c"), "complete", order=[F.col("n").desc(), "word"])
    runs.finish(query, LIMIT)
    batch = words.plain_counts(spark.read.text(str(book / "in")))
    got = runs.last_batch(spark, out, counts.schema)
    assert values(got) == values(batch)
    assert len(list((book / "out").glob("batch_id=*"))) == 3


def test_restart_continues_the_counts(spark, book):
    def go():
        stream = text_stream(spark, path=str(book / "in"), files_per_trigger=1)
        counts = words.letter_counts(stream)
        query = runs.write_batches(counts, str(book / "out"), str(book / "c"), "update")
        runs.finish(query, LIMIT)
        return counts.schema

    go()
    put(book / "in", "d.txt", "new Words be")
    schema = go()
    got = runs.last_per_key(spark, str(book / "out"), schema, ["letter"])
    assert values(got) == values(words.letter_counts(spark.read.text(str(book / "in"))))


def test_log_lines(spark, book):
    lines = words.log_lines(words.letter_counts(spark.read.text(str(book / "in"))))
    assert values(lines) == [("b: 3",), ("n: 1",), ("o: 3",), ("t: 2",)]


def test_console_and_processing_time(spark, book):
    stream = windows.with_processing_time(text_stream(spark, path=str(book / "in")))
    counts = windows.word_windows(windows.timed_words(stream))
    query = runs.to_console(counts.orderBy(*windows.word_order()), str(book / "c"), "complete")
    runs.finish(query, LIMIT)
    assert query.lastProgress["numInputRows"] == 5
    assert "Console" in query.lastProgress["sink"]["description"]


def test_other_formats_pass_through(spark):
    stream = text_stream(spark, format="rate", rowsPerSecond=1)
    assert stream.isStreaming and stream.dtypes == [("value", "string")]


def test_overdue_stream_is_stopped(spark, book):
    stream = text_stream(spark, path=str(book / "in"))
    query = runs.write_batches(stream, str(book / "o"), str(book / "c"), trigger={"processingTime": "1 second"})
    with pytest.raises(TimeoutError):
        runs.finish(query, 3)
    assert not query.isActive


TIMED = ["2020-01-01T00:00:05,war and", "2020-01-01T00:00:20,peace", "2020-01-01T00:00:59,war"]


def timed(lines):
    part = F.split("value", ",")
    return lines.select(part[0].cast("timestamp_ntz").alias("ts"), part[1].alias("value"))


def test_sliding_words(spark, tmp_path):
    put(tmp_path / "in", "a", *TIMED)
    batch = windows.with_event_time(timed(spark.read.text(str(tmp_path / "in"))), "ts", late=None)
    got = windows.word_windows(windows.timed_words(batch)).where("word = 'war'").orderBy("window_start")
    spans = [(r["window_start"].strftime("%H:%M:%S"), r["window_end"].strftime("%H:%M:%S"), r["n"]) for r in got.collect()]
    assert spans == [
        ("23:59:45", "00:00:15", 1),
        ("00:00:00", "00:00:30", 1),
        ("00:00:30", "00:01:00", 1),
        ("00:00:45", "00:01:15", 1),
    ]


def test_watermark_finishes_windows_and_drops_late_rows(spark, tmp_path):
    folder = tmp_path / "in"

    def go():
        stream = windows.with_event_time(timed(text_stream(spark, path=str(folder))), "ts")
        counts = windows.keyword_windows(stream, F.col("value").contains("war"), "20 seconds", "10 seconds")
        runs.finish(runs.write_batches(counts, str(tmp_path / "o"), str(tmp_path / "c")), LIMIT)
        return runs.read_batches(spark, str(tmp_path / "o"), counts.schema)

    put(folder, "a", *TIMED)
    first = go()
    assert [tuple(r)[2:4] for r in first.orderBy("window_start").collect()] == [(1, 1), (1, 1), (1, 0), (1, 0)]
    put(folder, "b", "2020-01-01T00:00:06,late war", "2020-01-01T00:02:00,end")
    second = go()
    # Only the windows of 00:00:59 are new; the late row changed nothing.
    assert second.count() == 6
    assert second.agg(F.sum("total_count")).first()[0] == 6


MESSAGES = [
    '{"title":"a","comment_count":150,"content":"war"}',
    '{"title":"b","commentCount":3,"content":["no","war"]}',
    '{"title":"c","comment_count":101}',
    "broken {",
]


def test_fan_out_to_four_sinks_and_a_replayed_batch(spark, tmp_path):
    put(tmp_path / "in", "a", *MESSAGES[:2])
    put(tmp_path / "in", "b", *MESSAGES[2:])
    branches = {
        "raw": fanout.Branch(lambda d: d.select("value"), "text"),
        "titles": fanout.Branch(lambda d: d.select("title"), "csv"),
        "alerts": fanout.Branch(lambda d: fanout.alerts(d).select("title", "comment_count"), "csv", {"header": True}),
        "content": fanout.Branch(lambda d: d.select("content"), "parquet"),
    }
    stream = parse_articles(text_stream(spark, path=str(tmp_path / "in"), files_per_trigger=1), "value")
    out = str(tmp_path / "out")
    runs.finish(fanout.fan_out(stream, branches, out, str(tmp_path / "c1")), LIMIT)
    read = spark.read.option("header", True)
    assert sorted(r["value"] for r in spark.read.text(f"{out}/raw").collect()) == sorted(MESSAGES)
    alerts = read.csv(f"{out}/alerts").select("title", "comment_count")
    assert values(alerts) == [("a", "150"), ("c", "101")]
    assert spark.read.parquet(f"{out}/content").count() == 4
    # The same input once more, as after a lost commit: batches are replaced.
    runs.finish(fanout.fan_out(stream, branches, out, str(tmp_path / "c2")), LIMIT)
    assert spark.read.text(f"{out}/raw").count() == 4


def test_csv_sink(spark, tmp_path):
    put(tmp_path / "in", "a", *MESSAGES)
    stream = parse_articles(text_stream(spark, path=str(tmp_path / "in"))).select("title", "comment_count")
    runs.finish(runs.to_csv(stream, str(tmp_path / "o"), str(tmp_path / "c"), every=None, per_file=2), LIMIT)
    assert spark.read.csv(str(tmp_path / "o")).count() == 4
    assert len(list((tmp_path / "o").glob("part-*"))) == 2


# key, seq, day; files are batches. Key 1 is late at 2 (in the batch), at 5 and 6
# (across batches); the row with number 0 arrives after its successors.
BATCHES = [
    ["1,1,2020-01-05", "1,2,2020-01-03", "2,3,2020-01-09", "1,4,2020-01-04"],
    ["1,5,2020-01-02", "2,7,2020-01-10", "1,6,2020-01-01"],
    ["1,0,2019-01-01", "3,8,2020-01-01", "2,9,"],
]


def records(lines):
    part = F.split("value", ",")
    return lines.select(
        part[0].cast("long").alias("k"),
        part[1].cast("long").alias("seq"),
        part[2].try_cast("timestamp_ntz").alias("ts"),
    )


def _order_stream(spark, tmp_path, upto=3):
    import os

    for i, rows in enumerate(BATCHES[:upto]):
        name = tmp_path / "in" / f"f{i}"
        if not name.exists():
            put(tmp_path / "in", f"f{i}", *rows)
            os.utime(name, (1_600_000_000 + i * 60,) * 2)  # files arrive in order
    return records(text_stream(spark, path=str(tmp_path / "in"), files_per_trigger=1))


KEYED = [(1, 0), (1, 2), (1, 5), (1, 6)]


@pytest.mark.parametrize("keys", [["k"], []])
def test_batchwise_detector(spark, tmp_path, keys):
    for upto in (1, 3):
        stream = _order_stream(spark, tmp_path, upto)
        query = detector.by_batches(
            stream, "seq", "ts", str(tmp_path / "o"), str(tmp_path / "y"), str(tmp_path / "c"), keys=keys, bucket_rows=2
        )
        runs.finish(query, LIMIT)
    got = runs.read_batches(spark, str(tmp_path / "o"), stream.schema.add("prev_ts", "timestamp_ntz"))
    # Keyless: 2, 4 after 3, 5 after 4, 6 after 5; 0 arrives after 7; 8 after 0 is not late.
    expected = KEYED if keys else [(1, 0), (1, 2), (1, 4), (1, 5), (1, 6)]
    assert values(got.select("k", "seq")) == expected


def test_detectors_equal_the_batch_form_when_order_holds(spark, tmp_path):
    rows = [f"{i * 7 % 5},{i},2020-01-{i * 11 % 28 + 1:02d}" for i in range(60)]
    import os

    for i in range(3):
        put(tmp_path / "in", f"f{i}", *rows[i * 20 : i * 20 + 20])
        os.utime(tmp_path / "in" / f"f{i}", (1_600_000_000 + i * 60,) * 2)
    batch = records(spark.read.text(str(tmp_path / "in")))
    stream = records(text_stream(spark, path=str(tmp_path / "in"), files_per_trigger=1))
    paths = [str(tmp_path / x) for x in ("o", "y", "c")]
    runs.finish(detector.by_batches(stream, "seq", "ts", *paths, keys=["k"]), LIMIT)
    schema = stream.schema.add("prev_ts", "timestamp_ntz")
    got = runs.read_batches(spark, paths[0], schema).drop("batch_id")
    assert values(got) == values(order.out_of_order(batch, "ts", "seq", ["k"]))


def test_carried_rows_are_folded_and_old_ones_removed(spark, tmp_path, monkeypatch):
    import os

    monkeypatch.setattr(detector, "COMPACT", 2)
    rows = [f"{i * 7 % 5},{i},2020-01-{i * 11 % 28 + 1:02d}" for i in range(60)]
    for i in range(6):
        put(tmp_path / "in", f"f{i}", *rows[i * 10 : i * 10 + 10])
        os.utime(tmp_path / "in" / f"f{i}", (1_600_000_000 + i * 60,) * 2)
    stream = records(text_stream(spark, path=str(tmp_path / "in"), files_per_trigger=1))
    paths = [str(tmp_path / x) for x in ("o", "y", "c")]
    runs.finish(detector.by_batches(stream, "seq", "ts", *paths, keys=["k"]), LIMIT)
    schema = stream.schema.add("prev_ts", "timestamp_ntz")
    got = runs.read_batches(spark, paths[0], schema).drop("batch_id")
    batch = records(spark.read.text(str(tmp_path / "in")))
    assert values(got) == values(order.out_of_order(batch, "ts", "seq", ["k"]))
    assert sorted(os.listdir(paths[1])) == ["batch_id=2", "batch_id=3", "batch_id=4", "batch_id=5"]


def test_a_table_stream_reads_no_sibling(spark, tmp_path):
    for name, n in (("t.parquet", 3), ("t.parquet_old", 5)):
        spark.range(n).write.parquet(str(tmp_path / name))
    one = next((tmp_path / "t.parquet").glob("part-*"))
    single = tmp_path / "single"
    single.mkdir()
    for name in ("u.parquet", "u.parquet_old"):
        (single / name).write_bytes(one.read_bytes())
    for i, path in enumerate((tmp_path / "t.parquet", single / "u.parquet")):
        stream = table_stream(spark, str(path))
        runs.finish(runs.write_batches(stream, str(tmp_path / f"o{i}"), str(tmp_path / f"c{i}")), LIMIT)
        whole = spark.read.parquet(str(path)).count()
        assert runs.read_batches(spark, str(tmp_path / f"o{i}"), stream.schema).count() == whole


@pytest.mark.parametrize("event_time", [True, False])
def test_article_job(spark, tmp_path, event_time):
    days = ["2022-01-05", "2022-01-03", "2022-01-07", "2022-01-06"]
    rows = [
        f'{i},2022-02-01 00:0{i}:00,{{"title":"t{i}","comment_count":{99 + i},"time":"{d}","content":"{w}"}}'
        for i, (d, w) in enumerate(zip(days, ["war", "no", "war x", "no"]))
    ]
    put(tmp_path / "in", "a", *rows)

    def messages():
        part = F.split("value", ",", 3)
        return text_stream(spark, path=str(tmp_path / "in")).select(
            part[0].cast("long").alias("seq"), part[1].cast("timestamp_ntz").alias("ts"), part[2].alias("value")
        )

    out = str(tmp_path / "out")
    started = start_articles(
        messages, out, str(tmp_path / "c"), "war", "seq", size="2 minutes", slide="1 minute", ts="ts" if event_time else None
    )
    for query in started.values():
        runs.finish(query, LIMIT)
    read = spark.read.option("header", True)
    assert sorted(r["title"] for r in read.csv(f"{out}/titles").collect()) == ["t0", "t1", "t2", "t3"]
    assert sorted(r["title"] for r in read.csv(f"{out}/high_priority").collect()) == ["t2", "t3"]
    assert sorted(r["title"] for r in spark.read.parquet(f"{out}/out_of_order").collect()) == ["t1", "t3"]
    if event_time:
        counts = spark.read.schema("s string, e string, total long, war long, batch_id long").csv(f"{out}/counts")
        # Windows ending by 00:03, the last time seen.
        assert sorted((r["total"], r["war"]) for r in counts.collect()) == [(1, 1), (2, 1), (2, 1)]


def test_a_stretch_of_documents_can_be_read_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "PART_BYTES", 16 << 10)
    monkeypatch.setattr(streams, "scratch", lambda spark, label: str(tmp_path / label))
    text = F.concat(F.sha2(F.col("id").cast("string"), 512), F.lit(" word "))
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = streams.stream_letter_changes(spark, str(tmp_path)).where("letter = 'w'")
    assert got.agg(F.count("*"), F.min("n"), F.max("n")).first()[:] == (4000, 1, 4000)
    files = [p for p in (tmp_path / "changes" / "in").iterdir() if p.name.startswith("part-")]
    assert len(files) == streams.BATCHES
    assert min(pq.ParquetFile(p).metadata.num_row_groups for p in files) > 3
