"""Elements of nested, unclosed and broken markup."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gristmill.functions import markup
from gristmill.operators import corpus

NESTED = """<!DOCTYPE html><div class="outer first"><!-- </div> <div id="deep"> -->
<script>var x = "</div><div id='deep'>";</script>
<div><div id="deep" title="a > b">one <div>two</div> three</div> four</div>
<DIV ID=other>five<div>six</div></DIV> seven</div><p>tail"""


def one(spark, page, column):
    cut = spark.createDataFrame([(page,)], "html string").select(markup.tokens(F.col("html")).alias("t"))
    return cut.select(column(F.col("t"))).first()[0]


def text_in(spark, page, *path):
    cut = spark.createDataFrame([(page,)], "html string").select(markup.tokens(F.col("html")).alias("t"))
    return markup.inside(cut, "t", path, "found").select(markup.text(F.col("found"))).first()[0]


@pytest.mark.parametrize(
    ("page", "path", "expected"),
    [
        (NESTED, ["#deep"], "one two three"),
        (NESTED, ["#deep", "div"], "two"),
        (NESTED, ["div#other"], "fivesix"),
        (NESTED, [".first", "#deep"], "one two three"),
        (NESTED, ["p"], "tail"),
        (NESTED, ["#missing"], ""),
        (NESTED, ["#missing", "div"], ""),
        ("<article>a<article>b</article>c</article>d", ["article"], "abc"),
        ("<article>a<article>b</article>c", ["article"], "abc"),
        ("<div><p>x<div>y</div>", ["div"], "xy"),
        ("<div>a<br>b<img src='x>y'>c</div>", ["div"], "abc"),
        ("<br>x", ["br"], ""),
        ("a < b <b>1 < 2</b>", ["b"], "1 < 2"),
        ("<b></b>x", ["b"], ""),
        ("<bold>x</bold><b>y</b>", ["b"], "y"),
        ("", ["b"], ""),
        (None, ["b"], ""),
        ("<div " + "x='1' " * 3000 + ">deep" + "<div>" * 2000 + "in" + "</div>" * 2000 + "</div>out", ["div"], "deepin"),
    ],
)
def test_inside(spark, page, path, expected):
    assert text_in(spark, page, *path).strip().replace("\n", "") == expected


def test_tokens_are_the_whole_page(spark):
    for page in (NESTED, "<", "<<a>>", "x<!-- open", "<script>x", "a<b", "<a 'b>c", "&<>"):
        assert one(spark, page, lambda t: F.array_join(F.transform(t, lambda x: x["raw"]), "")) == page


@pytest.mark.parametrize(
    ("tag", "name", "expected"),
    [
        ("<a href='x y'>", "href", "x y"),
        ('<a class="b c" href="u?a=1&amp;b=2">', "href", "u?a=1&b=2"),
        ("<a HREF = plain>", "href", "plain"),
        ('<a data-href="no">', "href", ""),
        ("<a>", "href", ""),
    ],
)
def test_attributes(spark, tag, name, expected):
    df = spark.createDataFrame([(tag,)], "v string")
    assert df.select(markup.attribute(F.col("v"), name)).first()[0] == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("&#65;&#x42;&#X1f600;", "AB😀"),
        ("&amp;lt; &lt; &nothing; & &#; &#x;", "&lt; < &nothing; & &#; &#x;"),
        ("&#0;&#xD800;&#99999999;", "���"),
        ("&#999999999999;", "&#999999999999;"),
        ("plain", "plain"),
        ("", ""),
    ],
)
def test_entities(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(markup.decoded(F.col("v"))).first()[0] == expected


def test_selectors_are_checked():
    assert markup.Selector.of("span.time-date") == markup.Selector("span", None, "time-date")
    assert markup.Selector.of("#a") == markup.Selector(None, "a", None)
    for wrong in ("", "a b", "p > a", ".a.b"):
        with pytest.raises(ValueError):
            markup.Selector.of(wrong)


PAGE = """<html><body><h1>Big &#38; <i>new</i></h1><div class="art-info x"><div class='time'>
<span class="other">no</span><span class="a time-date" content="2022-01-05T10:00">5. 1.</span></div></div>
<div class="opener"><div>Short</div> version</div>
<div id="art-text"><div><p>one &lt;b&gt;</p><div><p>two <b>bold</b><p>three</div></div><!-- <p>no</p> --></div><p>outside</p>
<div id="art-tags"><a href="/a">first</a>, <a>second</div><a>not one</a>
<div class="more-gallery"><a><span>12 photos</span></a></div><a id="moot-linkin"><span>(105 comments)</span></a></body>"""


def test_page_articles(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, "v", "<p>nothing</p>"), (3, None, None)], "page_id int, url string, html string")
    got = {r["page_id"]: r.asDict() for r in corpus.page_articles(pages).collect()}
    assert got[1] == {
        "page_id": 1,
        "url": "u",
        "title": "Big & new",
        "content": ["Short version", "one <b>", "two bold", "three"],
        "tags": ["first", "second"],
        "photo_count": 12,
        "time": "2022-01-05T10:00",
        "comment_count": 105,
    }
    for i in (2, 3):
        row = got[i]
        assert (row["title"], row["content"], row["tags"]) == ("", [""], [])
        assert (row["photo_count"], row["time"], row["comment_count"]) == (0, None, 0)
