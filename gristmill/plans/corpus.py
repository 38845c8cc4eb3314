"""Article statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.functions import html
from gristmill.operators import corpus, histogram
from gristmill.plans import bindings as b
from gristmill.plans.registry import query
from gristmill.plans.words import SPACE, words_sql
from gristmill.session import scratch
from gristmill.sources.readers import merge_parts as read_parts
from gristmill.sources.writers import write_articles

A, T = f"({b.ARTICLES_SQL})", f"({b.TIMED_ARTICLES_SQL})"
WORDS = f"len(list_filter(string_split_regex(body, '[{SPACE}]+'), lambda w: w <> ''))"
LETTERS = f"length(regexp_replace(body, '[{SPACE}]+', '', 'g'))"
BODY_WORDS = words_sql("body", table=A)


@query(f"SELECT count(*) AS articles, count(*) - count(DISTINCT url) AS duplicates FROM {A}")
def corpus_counts(spark, folder):
    return corpus.corpus_counts(b.articles(spark, folder))


@query(f"""
SELECT doc_id, url, title, comment_count FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY doc_id) AS nth FROM {A})
WHERE nth = 1""")
def dedup_first(spark, folder):
    rows = b.articles(spark, folder).select("doc_id", "url", "title", "comment_count")
    return corpus.dedup_first(rows, "url", "doc_id")


@query(f"SELECT strftime(min(published), '%Y-%m-%dT%H:%M:%S') AS oldest FROM {T}")
def oldest_article(spark, folder):
    return corpus.oldest_article(b.articles(spark, folder, timed=True), "doc_id")


@query(f"SELECT title, comment_count FROM {A} ORDER BY comment_count DESC, doc_id LIMIT 1")
def most_commented(spark, folder):
    return corpus.most_commented(b.articles(spark, folder), "doc_id")


@query(f"SELECT max(photo_count) AS most_photos, CAST(sum(comment_count) AS BIGINT) AS comments FROM {A}")
def corpus_extremes(spark, folder):
    return corpus.corpus_extremes(b.articles(spark, folder))


@query(f"SELECT round(avg(photo_count), 2) AS average_photos FROM {A}")
def avg_photos(spark, folder):
    return corpus.average_photos(b.articles(spark, folder))


@query(f"SELECT count(*) AS n FROM {A} WHERE comment_count > 100")
def over_100_comments(spark, folder):
    return corpus.over_comments(b.articles(spark, folder), 100)


@query(f"SELECT category, count(*) AS n FROM {T} WHERE year(published) = {b.YEAR} GROUP BY category")
def category_counts_year(spark, folder):
    return corpus.category_counts_year(b.articles(spark, folder, timed=True), b.YEAR)


@query(f"""
SELECT category, n, CAST((2000 * n + total) // (2 * total) AS DOUBLE) / 10.0 AS share FROM (
    SELECT category, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total
    FROM {A} GROUP BY category)""")
def category_share(spark, folder):
    return corpus.category_share(b.articles(spark, folder))


@query(f"SELECT CAST(year(published) AS INTEGER) AS year, count(*) AS n FROM {T} GROUP BY 1")
def articles_by_year(spark, folder):
    return corpus.by_year(b.articles(spark, folder, timed=True))


MONTHS = f"""
SELECT CAST(year(published) AS INTEGER) AS year, CAST(month(published) AS INTEGER) AS month, count(*) AS n
FROM {T} GROUP BY 1, 2"""


@query(MONTHS)
def articles_by_month(spark, folder):
    return corpus.by_month(b.articles(spark, folder, timed=True))


@query(f"""
(SELECT 'most' AS which, * FROM ({MONTHS}) ORDER BY n DESC, year, month LIMIT 1)
UNION ALL
(SELECT 'fewest' AS which, * FROM ({MONTHS}) ORDER BY n, year, month LIMIT 1)""")
def month_extremes(spark, folder):
    return corpus.month_extremes(b.articles(spark, folder, timed=True))


@query(f"""
SELECT CAST(d.day AS INTEGER) AS day, d.weekday, count(t.doc_id) AS n
FROM (VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'), (4, 'Thursday'),
             (5, 'Friday'), (6, 'Saturday'), (7, 'Sunday')) d(day, weekday)
LEFT JOIN {T} t ON isodow(t.published) = d.day GROUP BY 1, 2""")
def articles_by_weekday(spark, folder):
    return corpus.by_weekday(b.articles(spark, folder, timed=True))


@query(f"""
SELECT word, count(*) AS n FROM ({words_sql("title", f"year(published) = {b.YEAR}", T)})
GROUP BY word ORDER BY n DESC, word LIMIT 5""")
def title_words_year(spark, folder):
    return corpus.title_words_year(b.articles(spark, folder, timed=True), b.YEAR)


@query(f"SELECT CAST(sum({WORDS}) AS BIGINT) AS words FROM {A}")
def total_words(spark, folder):
    return corpus.total_words(b.articles(spark, folder))


@query(f"""
SELECT word, count(*) AS n FROM ({BODY_WORDS}) WHERE length(word) >= 6
GROUP BY word ORDER BY n DESC, word LIMIT 8""")
def long_words_top8(spark, folder):
    return corpus.long_words_top(b.articles(spark, folder))


MENTIONED = " + ".join(
    f"(length(lower(body)) - length(replace(lower(body), '{m}', ''))) // {len(m)}"
    for m in b.MENTIONS
)


@query(f"""
SELECT doc_id, title, CAST({MENTIONED} AS INTEGER) AS mentions FROM {A}
ORDER BY mentions DESC, doc_id LIMIT 3""")
def keyword_top3(spark, folder):
    return corpus.mention_top(b.articles(spark, folder), b.MENTIONS, "doc_id")


COUNTED = f"SELECT doc_id, title, CAST({WORDS} AS INTEGER) AS words FROM {A}"


@query(f"""
(SELECT 'longest' AS which, * FROM ({COUNTED}) ORDER BY words DESC, doc_id LIMIT 1)
UNION ALL
(SELECT 'shortest' AS which, * FROM ({COUNTED}) ORDER BY words, doc_id LIMIT 1)""")
def word_count_extremes(spark, folder):
    return corpus.word_count_extremes(b.articles(spark, folder), "doc_id")


@query(f"SELECT round(sum(length(word)) / count(*), 2) AS average_length FROM ({BODY_WORDS})")
def avg_word_length(spark, folder):
    return corpus.average_word_length(b.articles(spark, folder))


@query(f"SELECT doc_id, CAST({WORDS} AS INTEGER) AS words, comment_count FROM {A}")
def length_vs_comments(spark, folder):
    return corpus.length_vs_comments(b.articles(spark, folder), "doc_id")


def histogram_sql(value: str, bins: int = 30) -> str:
    edge = "CASE WHEN {i} = %d THEN hi ELSE ({i}) * ((hi - lo) / %d) + lo END" % (bins, bins)
    return f"""
    WITH v AS (SELECT CAST({value} AS DOUBLE) AS x FROM {A}),
    e AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                 CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v),
    f AS (SELECT CAST(range AS INTEGER) AS bin, {edge.format(i="range")} AS low,
                 {edge.format(i="range + 1")} AS high FROM range({bins}), e)
    SELECT bin, low, high, count(x) AS n
    FROM f LEFT JOIN v ON x >= low AND (x < high OR (bin = {bins - 1} AND x = high))
    GROUP BY bin, low, high"""


@query(histogram_sql(WORDS))
def word_count_hist(spark, folder):
    return histogram.histogram(corpus.word_totals(b.articles(spark, folder)), "words")


@query(histogram_sql(f"CASE WHEN {WORDS} > 0 THEN {LETTERS} / {WORDS} ELSE 0 END"))
def word_length_hist(spark, folder):
    return histogram.histogram(corpus.word_lengths(b.articles(spark, folder)), "mean_length")


@query(f"""
SELECT keyword, CAST(year(published) AS INTEGER) AS year, count(*) AS n
FROM {T} JOIN (SELECT unnest({list(b.KEYWORDS)}) AS keyword)
  ON contains(lower(title), keyword) GROUP BY 1, 2""")
def keyword_timeline(spark, folder):
    return corpus.keyword_timeline(b.articles(spark, folder, timed=True), b.KEYWORDS)


@query(f"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS item, value FROM (
    SELECT doc_id, unnest(items) AS value, generate_subscripts(items, 1) AS i FROM (
        SELECT doc_id, list_concat(
            list_transform(string_split(text, chr(10)), lambda x: CAST(to_json(x) AS VARCHAR)),
            ['"' || lang || '"', '"' || category || '"', CAST(photo_count AS VARCHAR)]) AS items
        FROM {A}))""")
def flatten_values(spark, folder):
    return corpus.flatten_values(b.articles(spark, folder), "doc_id")


@query(f"SELECT doc_id, body AS text FROM {A}")
def article_text(spark, folder):
    return corpus.article_text(b.articles(spark, folder), "doc_id")


@query(f"""
SELECT url, title, body, lang || ' ' || category AS tags, photo_count,
       comment_count, category FROM {A}""")
def merge_parts(spark, folder):
    """Articles written as four part folders and read back in one scan."""
    rows = b.articles(spark, folder).withColumn("part", F.pmod(F.col("doc_id"), F.lit(4)))
    base = scratch(spark, "parts")
    write_articles(rows.drop("doc_id"), base, by="part")
    merged = corpus.with_defaults(read_parts(spark, base, 4))
    return merged.select(
        "url",
        "title",
        corpus.body().alias("body"),
        F.concat_ws(" ", "tags").alias("tags"),
        "photo_count",
        "comment_count",
        "category",
    )


URL_PARTS = "string_split(url, '/')"


@query(f"""
SELECT page_id, url, CASE WHEN length(deeper) > 12 THEN section ELSE deeper END AS category
FROM (
    SELECT *, p[4] AS section,
           CASE WHEN p[4] = 'en' AND len(p) > 5 THEN p[5] ELSE p[4] END AS deeper
    FROM (SELECT page_id, url, {URL_PARTS} AS p,
                 regexp_extract(html, '(?s)<h1\\b[^>]*>(.*?)</h1>', 1) AS title FROM pages))
WHERE title <> '' AND len(p) > 3 AND (p[3] = '{b.SITE}' OR ends_with(p[3], '.{b.SITE}'))""")
def url_category(spark, folder):
    """Pages of one site with the category of their address; 'en' is the nested
    section here."""
    pages = b.texts(spark, folder, "pages").select(
        "page_id", "url", F.regexp_extract("html", r"(?s)<h1\b[^>]*>(.*?)</h1>", 1).alias("title")
    )
    host = corpus.on_site(corpus.url_part(2), b.SITE)
    return corpus.url_category(pages, host, nested="en").select("page_id", "url", "category")


@query(f"SELECT count(DISTINCT category) AS categories FROM ({b.ARTICLES_SQL})")
def category_number(spark, folder):
    return corpus.category_number(b.articles(spark, folder))


def plain_sql(markup: str) -> str:
    text = f"regexp_replace({markup}, '<[^>]*>', '', 'g')"
    for entity, char in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "''"),
        ("&nbsp;", " "),
        ("&amp;", "&"),
    ):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


@query(f"""
SELECT page_id, url, {plain_sql("h")} AS title,
       {plain_sql("array_to_string(p, chr(10))")} AS content,
       CAST(len(p) AS INTEGER) AS paragraphs,
       {plain_sql("array_to_string(a, chr(10))")} AS tags,
       CAST(len(a) AS INTEGER) AS links
FROM (
    SELECT page_id, url,
           regexp_extract(html, '(?s)<h1\\b[^>]*>(.*?)</h1>', 1) AS h,
           list_transform(
               string_split(regexp_extract(html, '(?s)<article\\b[^>]*>(.*?)</article>', 1),
                            '<p>')[2:],
               lambda x: split_part(x, '</p>', 1)) AS p,
           regexp_extract_all(
               regexp_extract(html, '(?s)<nav\\b[^>]*>(.*?)</nav>', 1),
               '(?s)<a\\b[^>]*>(.*?)</a>', 1) AS a
    FROM pages)""")
def page_fields(spark, folder):
    fields = corpus.page_fields(b.texts(spark, folder, "pages"))
    return fields.drop("photo_count", "comment_count")


def _article_page():
    """A page of an article site around the paragraphs of a given page: the parts stand in nested
    elements of the same name, beside comments and scripts that hold end tags."""
    paragraphs = html.paragraphs(F.col("html"))
    text_lines = F.transform(paragraphs, lambda p: F.concat(F.lit("<div><div><p>"), p, F.lit("</p></div></div>")))
    number = F.col("page_id").cast("string")
    return F.concat(
        F.lit("<!-- <h1>no</h1> --><script>var x = \"</div><div id='art-text'>\";</script><div><h1>Nr. &#"),
        (65 + F.pmod("page_id", F.lit(26))).cast("string"),
        F.lit("; <i>&#x1F600;</i> "),
        number,
        F.lit("</h1><div class='art-info wide'><div class='time'><span>no</span><span class=\"a time-date\" content='2022-01-"),
        F.lpad((1 + F.pmod("page_id", F.lit(28))).cast("string"), 2, "0"),
        F.lit("T10:00'>x</span></div></div></div><div class='opener'><div>Intro <div>of</div></div> "),
        F.col("url"),
        F.lit("</div><div id='art-text' title='a > b'>"),
        F.array_join(text_lines, "<!-- </div> -->"),
        F.lit("</div><p>outside</p><div id='art-tags'><a>lang</a><a>page "),
        number,
        F.lit("</div><div class='more-gallery'><div><span>"),
        F.pmod("page_id", F.lit(40)).cast("string"),
        F.lit(" photos</span></div></div><a id='moot-linkin'><span>("),
        F.pmod("page_id", F.lit(300)).cast("string"),
        F.lit(" comments)</span></a>"),
    )


@query(f"""
SELECT page_id, url, 'Nr. ' || chr(CAST(65 + page_id % 26 AS INTEGER)) || ' 😀 ' || page_id AS title,
       array_to_string(list_prepend('Intro of ' || url, list_transform(p, lambda x: {plain_sql("x")})), chr(10)) AS content,
       CAST(len(p) + 1 AS INTEGER) AS parts, 'lang,page ' || page_id AS tags, CAST(page_id % 40 AS INTEGER) AS photo_count,
       '2022-01-' || lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0') || 'T10:00' AS time,
       CAST(page_id % 300 AS INTEGER) AS comment_count
FROM (
    SELECT page_id, url,
           list_transform(
               string_split(regexp_extract(html, '(?s)<article\\b[^>]*>(.*?)</article>', 1), '<p>')[2:],
               lambda x: split_part(x, '</p>', 1)) AS p
    FROM pages)""")
def page_articles(spark, folder):
    """Every field of an article read from a page whose elements are nested in ones of the same name;
    the twin has the fields as they were put in."""
    pages = b.texts(spark, folder, "pages").select("page_id", "url", _article_page().alias("html"))
    found = corpus.page_articles(pages)
    return found.select(
        "page_id",
        "url",
        "title",
        F.array_join("content", "\n").alias("content"),
        F.size("content").alias("parts"),
        F.array_join("tags", ",").alias("tags"),
        "photo_count",
        "time",
        "comment_count",
    )
