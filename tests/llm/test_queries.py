"""The registered queries with a SQL twin, side by side."""

from __future__ import annotations

import pytest

from gristmill.llm.queries import LLM_QUERIES
from tests.oracle import DATA, compare, connect

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n, q in LLM_QUERIES.items() if q.sql])
def test_twin(spark, db, name):
    assert compare(LLM_QUERIES[name].run(spark, FOLDER), db, LLM_QUERIES[name].sql) == []


def test_one_query_for_each_operator():
    assert [n for n in range(1, 11) if any(q.startswith(f"op{n}_") for q in LLM_QUERIES)] == list(range(1, 11))
