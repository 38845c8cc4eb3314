from __future__ import annotations

import json

from pyspark.sql import functions as F

from gristmill.operators import corpus, words
from gristmill.sources import readers, writers

RECORDS = [
    {"url": "u1", "title": "t1", "content": ["a", "b"], "tags": ["x"], "photo_count": 2, "time": None, "comment_count": 1, "category": "c"},
    {"url": "u2", "title": "č", "content": [], "tags": [], "photo_count": "many"},
]


def values(df):
    return [tuple(r) for r in df.collect()]


def test_array_file_and_broken_file(spark, tmp_path):
    good, broken = tmp_path / "good.json", tmp_path / "broken.json"
    good.write_text(json.dumps(RECORDS, indent=4, ensure_ascii=False), encoding="utf-8")
    broken.write_text('[{"url": "u9", ', encoding="utf-8")
    got = readers.read_articles(spark, str(good), array_file=True)
    assert sorted(values(got.select("url", "photo_count"))) == [("u1", 2), ("u2", None)]
    assert readers.read_articles(spark, str(broken), array_file=True).count() == 0


def test_merge_parts_skips_missing_files(spark, tmp_path):
    for i in (0, 2):
        df = spark.createDataFrame([(f"u{i}", "t")], "url string, title string")
        writers.write_articles(df, str(tmp_path / f"part={i}"))
    got = readers.merge_parts(spark, str(tmp_path), 4)
    assert sorted(r["url"] for r in got.collect()) == ["u0", "u2"]
    assert readers.merge_parts(spark, str(tmp_path / "none"), 2).count() == 0


def test_article_round_trip(spark, tmp_path):
    source = tmp_path / "in.json"
    source.write_text(json.dumps(RECORDS[:1]), encoding="utf-8")
    first = readers.read_articles(spark, str(source), array_file=True)
    writers.write_articles(first, str(tmp_path / "out"))
    assert values(readers.read_articles(spark, str(tmp_path / "out"))) == values(first)


def test_content_column_alone_is_read(spark, tmp_path):
    writers.write_articles(spark.createDataFrame([("u", ["p q", "r"])], "url string, content array<string>"), str(tmp_path / "a"))
    text = readers.read_articles(spark, str(tmp_path / "a")).select(corpus.body().alias("value"))
    plan = text._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<content:array<string>>" in plan
    assert sorted(values(words.word_counts(text))) == [("p", 1), ("q", 1), ("r", 1)]


def test_delimited_tables(spark, tmp_path):
    item = tmp_path / "item"
    item.write_bytes("﻿1|First\nx|Second\n3|Třetí\n".encode())
    got = readers.read_delimited(spark, str(item), "id int, title string", sep="|", view="items")
    assert values(got) == [(1, "First"), (None, "Second"), (3, "Třetí")]
    assert spark.sql("SELECT count(*) FROM items WHERE id IS NULL").first()[0] == 1

    plain = tmp_path / "plain.csv"
    plain.write_text("44,8602,37.19\n35,5368,65.89\n")
    got = readers.read_delimited(spark, str(plain), names=("customer_id", "item", "amount"))
    assert got.dtypes == [("customer_id", "int"), ("item", "int"), ("amount", "double")]

    head = tmp_path / "head.csv"
    head.write_text("id,name,age\n0,Will,33\n")
    got = readers.read_delimited(spark, str(head), header=True)
    got.printSchema()
    assert got.columns == ["id", "name", "age"] and values(got) == [(0, "Will", 33)]

    names = tmp_path / "names"
    names.write_text('1 "24-HOUR MAN/EMMANUEL"\n2 "3-D MAN/CHARLES"\n')
    got = readers.read_delimited(spark, str(names), "id int, name string", sep=" ")
    assert values(got)[0] == (1, "24-HOUR MAN/EMMANUEL")


def test_lines_and_chunks(spark, tmp_path):
    data = readers.from_lines(spark, ["to be", "or\nnot"])
    writers.write_lines(data, str(tmp_path / "t"))
    assert sorted(values(readers.read_lines(spark, str(tmp_path / "t")))) == [("or not",), ("to be",)]
    many = spark.range(0, 10, 1, 1).select(F.col("id").cast("string").alias("value"))
    writers.write_lines(many, str(tmp_path / "c"), per_file=4)
    assert len(list((tmp_path / "c").glob("part-*"))) == 3


def test_csv_round_trip_and_sorted_output(spark, tmp_path):
    df = spark.createDataFrame([(2, 1, 1.5), (1, 2, 2.5), (1, 1, 0.5)], "user int, item int, v double")
    writers.write_csv(df, str(tmp_path / "p"))
    back = readers.read_delimited(spark, str(tmp_path / "p"), header=True)
    assert sorted(values(back)) == sorted(values(df))
    writers.write_sorted(df, str(tmp_path / "s"), "user", "item")
    text = "".join(p.read_text() for p in sorted((tmp_path / "s").glob("part-*")))
    assert text == "1\t1\t0.5\n1\t2\t2.5\n2\t1\t1.5\n"
