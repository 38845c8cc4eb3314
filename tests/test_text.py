from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from gristmill.functions import html, text, times
from gristmill.operators import words

ACCENT = "čas abc1 abc_ abc def éa x"


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "value string").select(column(F.col("value"))).first()[0]


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_word_runs_follow_unicode_boundaries(spark):
    got = pairs(words.letter_counts(lines(spark, ACCENT)))
    # Words of ASCII letters only: abc, def, e, a, x.
    assert got == [("a", 2), ("d", 1), ("e", 1), ("x", 1)]


@pytest.mark.parametrize("value", [ACCENT, "A no break ½ under_score, it's!", "  ", "x y\x1cz\x85q"])
def test_normalise_equals_unicode_regex(spark, value):
    assert one(spark, value, text.normalise) == re.sub(r"[^\w\s]", "", value.lower())


@pytest.mark.parametrize("value", ["", " a b ", "a b　c\x85d", "\x1ca\x1fb", "one"])
def test_word_count_and_letters(spark, value):
    found = value.split()
    assert one(spark, value, text.word_count) == len(found)
    assert one(spark, value, text.letter_total) == sum(map(len, found))


def test_mean_word_length(spark):
    assert one(spark, "ab cdef", text.mean_word_length) == 3.0
    assert one(spark, "  ", text.mean_word_length) == 0.0


def test_plain_counts_keep_empty_words(spark):
    got = pairs(words.plain_counts(lines(spark, "", " a b ", "A!")))
    # '' gives one empty word, ' a b ' gives two, 'A!' becomes 'a'.
    assert got == [("", 3), ("a", 2), ("b", 1)]


def test_ascii_view_does_not_regroup(spark):
    counts = words.word_counts(lines(spark, "é éa a a ň"), normalised=False)
    assert pairs(words.ascii_view(counts)) == [("a", 1), ("a", 2)]


def test_top_breaks_ties_by_word(spark):
    counts = words.word_counts(lines(spark, "b a c, C. a b d"))
    assert [tuple(r) for r in words.top(counts, 3, "word").collect()] == [("a", 2), ("b", 2), ("c", 2)]


def test_min_length_counts_characters(spark):
    counts = words.word_counts(lines(spark, "příliš krátké ababab ééééé"), min_length=6)
    assert pairs(counts) == [("ababab", 1), ("krátké", 1), ("příliš", 1)]


def test_mentions_add_overlapping_literals(spark):
    got = one(
        spark,
        "Covid covid-19 COVID 19",
        lambda c: text.mentions(c, ("covid", "covid-19", "covid 19")),
    )
    assert got == 3 + 1 + 1
    with pytest.raises(ValueError):
        text.occurrences(F.col("value"), "")


def test_json_quoted(spark):
    assert one(spark, 'say "hi"\n\té', text.json_quoted) == '"say \\"hi\\"\\n\\té"'


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2021-05-06T07:08:09", "2021-05-06 07:08:09"),
        ("2021-05-06T07:08:09+02:00", "2021-05-06 07:08:09"),
        ("2021-05-06T07:08Z", "2021-05-06 07:08:00"),
        ("2021-05-06", "2021-05-06 00:00:00"),
        ("2021-13-06", None),
        ("2021-02-30T00:00:00", None),
        ("2021", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_iso(spark, value, expected):
    got = one(spark, value, times.parse_iso)
    assert (str(got) if got else None) == expected


def test_html_fields(spark):
    page = (
        '<nav><a href="/x">A &amp; B</a><a>C</a></nav><h1 class="t">Ti<b>t</b>le &lt;1&gt;</h1>'
        '<article><p>one<p class="q">two <i>2</i></p></article><p>outside</p>'
        '<span class="gallery">12 photos</span>'
    )
    assert one(spark, page, html.heading) == "Title <1>"
    assert one(spark, page, html.paragraphs) == ["one", "two <i>2</i>"]
    assert one(spark, page, html.link_texts) == ["A &amp; B", "C"]
    gallery = r'<span class="gallery">(\d+)'
    assert one(spark, page, lambda c: html.number_in(c, gallery)) == 12
    assert one(spark, "", lambda c: html.number_in(c, gallery)) == 0
    assert one(spark, "&amp;lt;", html.plain) == "&lt;"
