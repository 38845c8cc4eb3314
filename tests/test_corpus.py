from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions.records import ARTICLE
from gristmill.operators import corpus, histogram
from gristmill.operators.messages import parse_articles

SCHEMA = "pos long, url string, title string, content array<string>, tags array<string>, photo_count int, time string, comment_count int, category string"


def articles(spark, *rows):
    base = dict(url=None, title="t", content=[], tags=[], photo_count=0, time=None, comment_count=0, category="c")
    full = [{**base, "pos": i, **row} for i, row in enumerate(rows)]
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_url_category(spark):
    site = "https://www.site.cz"
    cases = {
        f"{site}/sport/x": "sport",
        f"{site}/revue/film/x": "film",  # six parts
        f"{site}/revue/film": "revue",  # five parts
        f"{site}/revue/abcdefghijklm/x": "revue",  # 13 characters are too many
        f"{site}/revue/abcdefghijkl/x": "abcdefghijkl",  # 12 are not
        "https://other.cz/sport/x": None,
        f"{site}": None,
    }
    data = articles(
        spark,
        *[{"url": u, "category": None} for u in cases],
        {"url": f"{site}/a/b", "title": ""},
        {"url": f"{site}/a/b", "title": None},
    )
    got = corpus.url_category(data, corpus.url_part(2) == "www.site.cz")
    assert dict(rows(got.select("url", "category"))) == {u: c for u, c in cases.items() if c}


def test_dedup_keeps_first_and_null_is_one_key(spark):
    data = articles(
        spark,
        {"url": "b", "title": "b0"},
        {"url": None, "title": "n1"},
        {"url": "a", "title": "a2"},
        {"url": "b", "title": "b3"},
        {"url": None, "title": "n4"},
    )
    for parts in (1, 4, 17):
        kept = corpus.dedup_first(data.repartition(parts), "url", "pos")
        assert sorted(r["title"] for r in kept.collect()) == ["a2", "b0", "n1"]
        assert kept.columns == data.columns
        assert rows(corpus.corpus_counts(data.repartition(parts))) == [(5, 2)]


def test_corpus_counts_of_nothing(spark):
    assert rows(corpus.corpus_counts(articles(spark).where("false"))) == [(0, 0)]


def test_times_and_extremes(spark):
    data = articles(
        spark,
        {"title": "late", "time": "2021-03-02T10:00:00", "comment_count": 7, "photo_count": 3},
        {"title": "bad", "time": "yesterday", "comment_count": 9, "content": ["a b", "c"]},
        {"title": "old", "time": "2020-12-31T23:59:00", "comment_count": 9, "photo_count": None},
        {"title": "same", "time": "2021-03-01T00:00:00", "comment_count": None, "content": ["x"]},
    )
    assert rows(corpus.oldest_article(data, "pos")) == [("2020-12-31T23:59:00",)]
    assert rows(corpus.most_commented(data, "pos")) == [("bad", 9)]
    assert rows(corpus.corpus_extremes(data)) == [(3, 25)]
    assert rows(corpus.over_comments(data, 8)) == [(2,)]
    assert rows(corpus.average_photos(data)) == [(1.0,)]
    assert sorted(rows(corpus.by_year(data))) == [(2020, 1), (2021, 2)]
    assert sorted(rows(corpus.month_extremes(data))) == [("fewest", 2020, 12, 1), ("most", 2021, 3, 2)]
    assert rows(corpus.category_counts_year(data, 2021)) == [("c", 2)]
    assert rows(corpus.by_weekday(data)) == [
        (1, "Monday", 1),
        (2, "Tuesday", 1),
        (3, "Wednesday", 0),
        (4, "Thursday", 1),
        (5, "Friday", 0),
        (6, "Saturday", 0),
        (7, "Sunday", 0),
    ]
    got = {r[0]: tuple(r)[1:] for r in corpus.word_count_extremes(data, "pos").collect()}
    assert got == {"longest": (1, "bad", 3), "shortest": (0, "late", 0)}


def test_month_extremes_tie_goes_to_the_earlier_month(spark):
    data = articles(spark, {"time": "2021-02-01"}, {"time": "2020-05-01"})
    assert sorted(rows(corpus.month_extremes(data))) == [("fewest", 2020, 5, 1), ("most", 2020, 5, 1)]


def test_words_and_keywords(spark):
    data = articles(
        spark,
        {"title": "Korona dnes korona", "time": "2020-01-01", "content": ["Korona a  korona-19", "slovo"], "category": "x"},
        {"title": "dnes", "time": "2020-02-01", "content": ["slovo slovo slovo dlouhé"], "category": "x"},
        {"title": "KORONA", "time": None, "content": [], "category": "y"},
    )
    assert rows(corpus.title_words_year(data, 2020, k=2)) == [("dnes", 2), ("Korona", 1)]
    assert rows(corpus.total_words(data)) == [(8,)]
    assert rows(corpus.long_words_top(data, k=2)) == [("Korona", 1), ("dlouhé", 1)]
    top = corpus.mention_top(data, ("korona", "korona-19"), "pos", k=2)
    assert rows(top.select("pos", "mentions")) == [(0, 3), (1, 0)]
    assert rows(corpus.keyword_timeline(data, ("korona", "dnes"))) == [
        ("korona", 2020, 1),
        ("dnes", 2020, 2),
    ]
    assert sorted(rows(corpus.category_share(data))) == [("x", 2, 66.7), ("y", 1, 33.3)]
    # 6+1+9+5 + 5+5+5+6 characters in 8 words
    assert rows(corpus.average_word_length(data)) == [(5.25,)]
    assert rows(corpus.length_vs_comments(data, "pos"))[0] == (0, 4, 0)
    assert rows(corpus.word_lengths(data))[2] == (0.0,)


def test_flatten_values_in_order(spark):
    data = articles(spark, {"content": ['a "b"', "č"], "tags": ["x"], "photo_count": 4}, {"content": None, "tags": None, "photo_count": None})
    assert rows(corpus.flatten_values(data, "pos")) == [
        (0, 0, '"a \\"b\\""'),
        (0, 1, '"č"'),
        (0, 2, '"x"'),
        (0, 3, "4"),
        (1, 0, "0"),
    ]


def test_defaults(spark):
    empty = spark.createDataFrame([(None,) * 8], ARTICLE)
    assert rows(corpus.with_defaults(empty).drop("category")) == [("", "", [], [], 0, "", 0)]


def hist(spark, *values, bins=3):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return [(r["bin"], r["n"]) for r in histogram.histogram(df, "v", bins).orderBy("bin").collect()]


def test_histogram_closes_the_last_bin(spark):
    assert hist(spark, 0.0, 1.0, 2.0, 3.0, 3.0, None) == [(0, 1), (1, 1), (2, 3)]


def test_histogram_widens_a_single_value(spark):
    assert hist(spark, 5.0, 5.0) == [(0, 0), (1, 2), (2, 0)]
    assert hist(spark, None) == []


def test_histogram_equals_numpy(spark):
    import numpy as np

    values = [round(0.1 * i * i, 3) for i in range(200)]
    counts, edges = np.histogram(values, bins=30)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = histogram.histogram(df, "v").orderBy("bin").collect()
    assert [r["n"] for r in got] == counts.tolist()
    assert [r["low"] for r in got] == edges[:-1].tolist()


def test_parse_articles(spark):
    cases = [
        ('{"title":"a","comment_count":3,"datePublished":"2022-01-02T03:04:05+01:00","content":"x"}', ("a", 3, "2022-01-02 03:04:05", "x")),
        ('{"title":"b","commentCount":"4","time":"2022-01-02","content":["x","y"]}', ("b", 4, "2022-01-02 00:00:00", "x y")),
        ('{"comment_count":1,"commentCount":2}', ("", 1, None, "")),
        ('{"title":"c","comment_count":2.9,"content":"[not a list]"}', ("c", 2, None, "[not a list]")),
        ('{"title":"d","time":""}', ("d", 0, None, "")),
        ('{"title":"e","time":null,"comment_count":5}', ("e", 5, None, "")),
        # Anything unreadable gives the default record.
        ('{"title":"f","comment_count":null}', ("", 0, None, "")),
        ('{"title":"g","comment_count":"many"}', ("", 0, None, "")),
        ('{"title":"h","comment_count":1,"time":"soon"}', ("", 0, None, "")),
        ('{"title":"i","comment_count":1', ("", 0, None, "")),
        ("[1,2]", ("", 0, None, "")),
        ("", ("", 0, None, "")),
    ]
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(cases)], "id long, value string")
    got = parse_articles(df, "id").orderBy("id").collect()
    for row, (message, expected) in zip(got, cases, strict=True):
        moment = str(row["publish_ts"]) if row["publish_ts"] else None
        assert (row["title"], row["comment_count"], moment, row["content"]) == expected, message


def test_filter_on_parsed_messages_parses_once(spark):
    message = F.concat(F.lit('{"comment_count":'), F.col("id") + 99, F.lit("}"))
    df = parse_articles(spark.range(4).select("id", message.alias("value")), "id")
    plan = df.where("comment_count > 100")
    text = plan._jdf.queryExecution().optimizedPlan().toString().lower()
    assert text.count("parse_json") + text.count("parsejson") == 1
    assert sorted(r["id"] for r in plan.collect()) == [2, 3]
