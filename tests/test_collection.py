"""Collections: loads, fields with and without a column, what a plan reads, texts that are no JSON."""

from __future__ import annotations

import pytest

from gristmill.sources.collection import Collection, load

FIELDS = {"title": "string", "comment_count": "int", "author.name": "string"}
TEXTS = [
    '{"title":"a","comment_count":5,"author":{"name":"Ann"},"tags":["x","y"],"extra":1.5}',
    '{"title":"b","comment_count":"many","author":null}',
    '{"title":null,"comment_count":7,"author":{"name":"Bob","born":1960}}',
    "{}",
    "[1,2]",
    "no json",
    '{"title":"cut',
    "",
    None,
]


@pytest.fixture
def collection(spark, tmp_path):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "value string")
    load(texts, str(tmp_path / "c"), FIELDS)
    return Collection(spark, str(tmp_path / "c"))


def test_columns_and_paths_say_the_same(collection):
    rows = collection.find("title", "comment_count", ("author.name", "string"), ("author.born", "int")).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [("a", 5, "Ann", None), ("b", None, None, None), (None, 7, "Bob", 1960), *[(None,) * 4] * 3], key=str
    )
    out = collection.find(("title", "string"), ("tags", "array<string>"), where=collection.field("comment_count") == 5)
    assert [tuple(r) for r in out.collect()] == [("a", ["x", "y"])]
    as_text = collection.find(("comment_count", "string"), where=collection.field("title") == "b").collect()
    assert [r[0] for r in as_text] == ["many"]
    with pytest.raises(ValueError):
        collection.field("tags")


def test_two_fields_read_two_columns(collection):
    plan = collection.find("title", "comment_count")._jdf.queryExecution().executedPlan().toString()
    read = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert read == "struct<title:string,comment_count:int,_raw:string>"


def test_texts_that_are_no_json_are_kept(collection):
    assert sorted(r[0] for r in collection.rejected().collect()) == ["", "no json", '{"title":"cut']


def test_loads_add_up(spark, tmp_path):
    path = str(tmp_path / "c")
    for i in range(3):
        load(spark.createDataFrame([(f'{{"title":"t{i}"}}',)], "value string"), path, FIELDS)
    assert sorted(r[0] for r in Collection(spark, path).find("title").collect()) == ["t0", "t1", "t2"]
    load(spark.createDataFrame([], "value string"), str(tmp_path / "e"), FIELDS)
    assert Collection(spark, str(tmp_path / "e")).find("title").count() == 0
