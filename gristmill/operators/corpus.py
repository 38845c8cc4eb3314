"""Statistics over articles: url, title, content, tags, photo_count, time,
comment_count, category, and a unique position that settles ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import html, markup, text, times
from gristmill.operators.words import count_by, explode_words, top


def _n() -> Column:
    return F.count(F.lit(1)).alias("n")


def body() -> Column:
    return text.joined(F.col("content"))


def with_defaults(articles: DataFrame) -> DataFrame:
    """Fill the fields a record may lack."""
    none = F.array().cast("array<string>")
    return articles.withColumns(
        {
            "url": F.coalesce("url", F.lit("")),
            "title": F.coalesce("title", F.lit("")),
            "content": F.coalesce("content", none),
            "tags": F.coalesce("tags", none),
            "photo_count": F.coalesce("photo_count", F.lit(0)),
            "time": F.coalesce("time", F.lit("")),
            "comment_count": F.coalesce("comment_count", F.lit(0)),
        }
    )


def url_category(
    articles: DataFrame,
    host: Column,
    nested: str = "revue",
    longest: int = 12,
) -> DataFrame:
    """Keep titled rows of one site and add the category named by the URL.

    ``host`` is the test the third URL part must pass (see ``url_part``). The
    fourth part is the category; under the nested section the fifth one is,
    unless it is longer than a category name may be.
    """
    part = F.split("url", "/")
    section = F.get(part, F.lit(3))
    deeper = F.when(
        (section == nested) & (F.size(part) > 5), F.get(part, F.lit(4))
    ).otherwise(section)
    return articles.where(
        F.col("title").isNotNull() & (F.col("title") != "") & (F.size(part) > 3) & host
    ).withColumn(
        "category", F.when(F.length(deeper) > longest, section).otherwise(deeper)
    )


def on_site(host: Column, site: str) -> Column:
    """Whether a host is the site or lies below it."""
    return (host == site) | host.endswith(f".{site}")


def category_number(articles: DataFrame) -> DataFrame:
    """How many different categories there are."""
    return articles.agg(F.count_distinct("category").alias("categories"))


def url_part(index: int) -> Column:
    return F.get(F.split("url", "/"), F.lit(index))


def dedup_first(articles: DataFrame, key: str, position: str) -> DataFrame:
    """Keep the first row of each key in position order; null is a key too.

    The smallest position per key is a hash aggregate that combines before the shuffle;
    the rows come from a semi join on key and position, so no row travels in a buffer.
    """
    first = articles.groupBy(F.col(key).alias("_key")).agg(F.min(position).alias("_first"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(position) == F.col("_first"))
    return articles.join(first, same, "left_semi")


def corpus_counts(articles: DataFrame, key: str = "url") -> DataFrame:
    """Rows and duplicates by key, all nulls being one key."""
    per_key = articles.groupBy(key).agg(_n())
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("articles"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicates"),
    )


def oldest_article(articles: DataFrame, position: str) -> DataFrame:
    """Time text of the oldest article with a valid time."""
    timed = articles.withColumn("at", times.parse_iso(F.col("time"))).where("at IS NOT NULL")
    return timed.agg(F.min_by("time", F.struct("at", position)).alias("oldest"))


def most_commented(articles: DataFrame, position: str) -> DataFrame:
    """Title and count of the row with most comments, the first one on ties."""
    rank = F.struct(F.col("comment_count"), -F.col(position))
    best = F.max_by(F.struct("title", "comment_count"), rank).alias("best")
    return articles.where("comment_count IS NOT NULL").agg(best).select("best.*")


def corpus_extremes(articles: DataFrame) -> DataFrame:
    return articles.agg(
        F.max("photo_count").alias("most_photos"),
        F.sum("comment_count").alias("comments"),
    )


def average_photos(articles: DataFrame) -> DataFrame:
    return articles.where("photo_count IS NOT NULL").agg(
        F.round(F.avg("photo_count"), 2).alias("average_photos")
    )


def over_comments(articles: DataFrame, limit: int = 100) -> DataFrame:
    return articles.where(F.col("comment_count") > limit).agg(_n())


def category_counts_year(articles: DataFrame, year: int) -> DataFrame:
    """Counts per category of rows whose time text starts with the year."""
    return articles.where(F.col("time").startswith(str(year))).groupBy("category").agg(_n())


def category_share(articles: DataFrame) -> DataFrame:
    """Count per category and its share in percent, to one place.

    The total is the sum of the few category counts; whole-number arithmetic
    rounds the same everywhere.
    """
    counts = articles.groupBy("category").agg(_n())
    total = counts.agg(F.sum("n")).scalar()
    return (
        counts.withColumn("total", total)
        .withColumn("share", F.expr("(2000 * n + total) div (2 * total) / 10.0D"))
        .select("category", "n", "share")
    )


def _timed(articles: DataFrame) -> DataFrame:
    return articles.withColumn("at", times.parse_iso(F.col("time"))).where("at IS NOT NULL")


def by_year(articles: DataFrame) -> DataFrame:
    return _timed(articles).groupBy(F.year("at").alias("year")).agg(_n())


def by_month(articles: DataFrame) -> DataFrame:
    return (
        _timed(articles)
        .groupBy(F.year("at").alias("year"), F.month("at").alias("month"))
        .agg(_n())
    )


def month_extremes(articles: DataFrame) -> DataFrame:
    """The months with most and fewest rows; the earlier one on ties."""
    first = -(F.col("year") * 100 + F.col("month"))
    row = F.struct("year", "month", "n")
    ends = by_month(articles).agg(
        F.max_by(row, F.struct(F.col("n"), first)).alias("most"),
        F.min_by(row, F.struct(F.col("n"), -first)).alias("fewest"),
    )
    return _stacked(ends, "most", "fewest")


def _stacked(one_row: DataFrame, *names: str) -> DataFrame:
    """Struct columns of one row as labelled rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias("which"), F.col(n).alias("r")) for n in names])
    return (
        one_row.select(F.explode(pairs).alias("p"))
        .where("p.r IS NOT NULL")
        .select("p.which", "p.r.*")
    )


def by_weekday(articles: DataFrame) -> DataFrame:
    """Counts for Monday to Sunday, zero where there is none."""
    day = F.weekday("at")
    counts = _timed(articles).agg(
        *[F.count(F.when(day == i, 1)).alias(name) for i, name in enumerate(times.WEEKDAYS)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(i + 1).alias("day"), F.lit(name).alias("weekday"), F.col(name).alias("n"))
            for i, name in enumerate(times.WEEKDAYS)
        ]
    )
    return counts.select(F.inline(rows))


def title_words_year(articles: DataFrame, year: int, k: int = 5) -> DataFrame:
    """Most frequent words, as written, in the titles of one year."""
    titles = _timed(articles).where(F.year("at") == year)
    return top(count_by(explode_words(titles, text.spaced(F.col("title"))), "word"), k, "word")


def total_words(articles: DataFrame) -> DataFrame:
    return articles.agg(
        F.coalesce(F.sum(text.word_count(body()).cast("long")), F.lit(0)).alias("words")
    )


def long_words_top(articles: DataFrame, k: int = 8, min_length: int = 6) -> DataFrame:
    words = explode_words(articles, text.spaced(body()), min_length=min_length)
    return top(count_by(words, "word"), k, "word")


def mention_top(
    articles: DataFrame, parts: Sequence[str], position: str, k: int = 3
) -> DataFrame:
    """Rows naming a keyword most often."""
    scored = articles.select(
        position, "title", text.mentions(body(), parts).alias("mentions")
    )
    return top(scored, k, position, by="mentions")


def word_count_extremes(articles: DataFrame, position: str) -> DataFrame:
    """Longest and shortest row by words, the first one on ties."""
    counted = articles.select(position, "title", text.word_count(body()).alias("words"))
    row = F.struct(position, "title", "words")
    ends = counted.agg(
        F.max_by(row, F.struct(F.col("words"), -F.col(position))).alias("longest"),
        F.min_by(row, F.struct("words", position)).alias("shortest"),
    )
    return _stacked(ends, "longest", "shortest")


def average_word_length(articles: DataFrame) -> DataFrame:
    return articles.agg(
        F.round(
            F.try_divide(
                F.sum(text.letter_total(body())), F.sum(text.word_count(body()))
            ),
            2,
        ).alias("average_length")
    )


def length_vs_comments(articles: DataFrame, position: str) -> DataFrame:
    return articles.select(position, text.word_count(body()).alias("words"), "comment_count")


def word_totals(articles: DataFrame) -> DataFrame:
    return articles.select(text.word_count(body()).alias("words"))


def word_lengths(articles: DataFrame) -> DataFrame:
    return articles.select(text.mean_word_length(body()).alias("mean_length"))


def keyword_timeline(articles: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Rows per keyword and year whose title holds the keyword.

    All keywords are counted in one pass per year; the few result rows are then
    turned, instead of copying every article once per keyword.
    """
    folded = F.lower("title")
    years = (
        _timed(articles)
        .groupBy(F.year("at").alias("year"))
        .agg(
            *[
                F.count(F.when(folded.contains(word), 1)).alias(f"k{i}")
                for i, word in enumerate(keywords)
            ]
        )
    )
    series = F.array(
        *[
            F.struct(F.lit(word).alias("keyword"), F.col(f"k{i}").alias("n"))
            for i, word in enumerate(keywords)
        ]
    )
    return years.select("year", F.inline(series)).where("n > 0").select("keyword", "year", "n")


def flatten_values(articles: DataFrame, position: str) -> DataFrame:
    """Content lines, tags and the photo count as one JSON literal each, in order."""
    none = F.array().cast("array<string>")
    values = F.concat(
        F.transform(F.coalesce("content", none), text.json_quoted),
        F.transform(F.coalesce("tags", none), text.json_quoted),
        F.array(F.coalesce("photo_count", F.lit(0)).cast("string")),
    )
    return articles.select(position, F.posexplode(values).alias("item", "value"))


def article_text(articles: DataFrame, position: str) -> DataFrame:
    """Whole text, one row per article."""
    return articles.select(position, body().alias("text"))


def page_fields(pages: DataFrame, photos: str | None = None, comments: str | None = None) -> DataFrame:
    """Article fields of raw pages; count patterns depend on the site."""
    raw = pages.select(
        "page_id",
        "url",
        html.heading(F.col("html")).alias("title"),
        html.paragraphs(F.col("html")).alias("p"),
        html.link_texts(F.col("html")).alias("a"),
        (html.number_in(F.col("html"), photos) if photos else F.lit(0)).alias("photo_count"),
        (html.number_in(F.col("html"), comments) if comments else F.lit(0)).alias("comment_count"),
    )
    return raw.select(
        "page_id",
        "url",
        "title",
        html.plain(F.concat_ws("\n", "p")).alias("content"),
        F.size("p").alias("paragraphs"),
        html.plain(F.concat_ws("\n", "a")).alias("tags"),
        F.size("a").alias("links"),
        "photo_count",
        "comment_count",
    )


# Where the fields of an article stand on its page. A path of selectors leads
# from an element to one inside it.
PAGE_TITLE = ("h1",)
PAGE_INTRO = (".opener",)
PAGE_TEXT = ("#art-text",)
PAGE_TAGS = ("#art-tags",)
PAGE_PHOTOS = (".more-gallery", "span")
PAGE_TIME = (".art-info", ".time", "span.time-date")
PAGE_COMMENTS = ("#moot-linkin", "span")


def page_articles(pages: DataFrame, key: str = "page_id", markup_column: str = "html") -> DataFrame:
    """The article of each raw page: title, content (the intro, then the paragraphs of the text),
    tags, photo count, time and comment count. A missing part is empty, a missing count 0 and a
    missing time null. Elements are found by their nesting (``functions.markup``)."""
    cut = pages.select(key, "url", markup.tokens(F.col(markup_column)).alias("_page"))
    parts = {
        "_title": PAGE_TITLE,
        "_intro": PAGE_INTRO,
        "_body": PAGE_TEXT,
        "_links": PAGE_TAGS,
        "_photos": PAGE_PHOTOS,
        "_comments": PAGE_COMMENTS,
    }
    for name, path in parts.items():
        cut = markup.inside(cut, "_page", path, name)
    cut = markup.inside(cut, "_page", PAGE_TIME, "_time", tag="_time_tag")
    time = markup.attribute(F.col("_time_tag"), "content")

    def plain_texts(area: str, pattern: str) -> Column:
        """Elements that cannot hold one another: the next one ends an unclosed one."""
        found = F.regexp_extract_all(markup.raw(F.col(area)), F.lit(pattern), 1)
        return F.transform(found, lambda x: markup.decoded(F.regexp_replace(x, markup.TAG, "")))

    return cut.select(
        key,
        "url",
        markup.text(F.col("_title")).alias("title"),
        F.concat(F.array(markup.text(F.col("_intro"))), plain_texts("_body", html.PARAGRAPH)).alias("content"),
        plain_texts("_links", html.OPEN_LINK).alias("tags"),
        markup.number(markup.text(F.col("_photos"))).alias("photo_count"),
        F.nullif(time, F.lit("")).alias("time"),
        markup.number(markup.text(F.col("_comments"))).alias("comment_count"),
    )
