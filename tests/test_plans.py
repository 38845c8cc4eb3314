"""What the plans must look like to hold at scale."""

from __future__ import annotations

from gristmill.operators import corpus, tables, words
from gristmill.plans import bindings as b

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_read(spark):
    text = plan(corpus.over_comments(b.articles(spark, FOLDER)))
    assert "ReadSchema: struct<n_chars:bigint>" in text
    text = plan(corpus.by_year(b.articles(spark, FOLDER, timed=True)))
    assert "text:string" not in text


def test_filters_reach_the_scan(spark):
    lines = b.table(spark, FOLDER, "lineitem").where("l_returnflag = 'R'")
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan(lines)


def test_counts_are_combined_before_the_shuffle(spark):
    text = plan(words.word_counts(b.text_lines(spark, FOLDER)))
    assert text.count("HashAggregate") == 2 and "partial_count" in text


def test_first_of_each_key_is_picked_before_the_shuffle(spark):
    text = plan(corpus.dedup_first(b.articles(spark, FOLDER), "url", "doc_id"))
    assert "partial_min" in text and "Window" not in text and "SortAggregate" not in text


def test_ratings_shrink_before_they_meet_titles(spark):
    text = plan(tables.most_hyped(b.votes(spark, FOLDER), b.movies(spark, FOLDER)))
    join = text.index("movie_id", text.index("Join"))
    assert text.index("partial_count", join) > join
