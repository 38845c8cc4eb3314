"""Every registered query: its twin's rows, types and names, and its plan."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from gristmill.plans.registry import QUERIES
from tests.oracle import DATA, compare, connect

FOLDER = f"{DATA}/sf0.001"
TOP_K = (
    "most_hyped",
    "word_count_top20",
    "long_word_top20",
    "long_words_top8",
    "keyword_top3",
    "title_words_year",
    "top_spenders",
    "graph_any_nodes",
    "random_row",
)


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name].run(spark, FOLDER)
    twin = QUERIES[name].sql
    if twin:
        assert compare(df, db, twin) == []
    else:
        assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan
    if name in TOP_K:
        assert "TakeOrderedAndProject" in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["title", "five_star_count", "total_count", "ratio"]
    assert df.count() == 10
