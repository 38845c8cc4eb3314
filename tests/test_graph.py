from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gristmill.operators import graph


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def nodes(spark):
    people = spark.createDataFrame(
        [(1, "Ann", 1950), (2, "Bob", 1960), (3, "Ann", 1970), (4, "Cyd", 1959), (5, None, 1980)],
        "id long, name string, born int",
    ).withColumn("labels", F.array(F.lit("Person")))
    films = spark.createDataFrame(
        [(11, "Sea"), (12, "Sky"), (13, "Sea")], "id long, title string"
    ).withColumn("labels", F.array(F.lit("Movie")))
    return people.unionByName(films, allowMissingColumns=True)


@pytest.fixture(scope="module")
def edges(spark):
    # Ann 1 twice in Sea 11 (parallel edges), null pay, and an edge to nowhere.
    return spark.createDataFrame(
        [
            (1, 11, "ACTED_IN", 10.0),
            (1, 11, "ACTED_IN", 20.0),
            (2, 11, "ACTED_IN", None),
            (2, 12, "ACTED_IN", None),
            (3, 12, "ACTED_IN", 60.0),
            (4, 99, "ACTED_IN", 70.0),
            (4, 13, "ACTED_IN", 5.0),
            (1, 2, "HAS_CONTACT", None),
            (1, 4, "HAS_CONTACT", None),
            (3, 3, "HAS_CONTACT", None),
        ],
        "src long, dst long, type string, earnings double",
    )


def test_any_nodes(nodes):
    assert [r["id"] for r in graph.any_nodes(nodes, k=2).collect()] == [1, 2]
    assert [r["id"] for r in graph.any_nodes(nodes, "Movie").collect()] == [11, 12, 13]


def test_neighbours_count_every_edge(nodes, edges):
    into = graph.in_neighbours(nodes, edges, F.col("title") == "Sea")
    assert rows(into) == [("Ann",), ("Ann",), ("Bob",), ("Cyd",)]
    out = graph.out_neighbours(nodes, edges, F.col("name") == "Ann")
    assert sorted(rows(out)) == [(11, "Sea"), (11, "Sea"), (12, "Sky")]


def brute_common(edges, people, a, b):
    acted = [(i, r["src"], r["dst"]) for i, r in enumerate(edges.collect()) if r["type"] == "ACTED_IN"]
    found = {}
    for i, s, d in acted:
        for j, t, e in acted:
            if d == e and i != j and people.get(s) == a and people.get(t) == b and d in (11, 12, 13):
                found[d] = found.get(d, 0) + 1
    return found


@pytest.mark.parametrize("pair", [("Ann", "Bob"), ("Ann", "Ann"), ("Bob", "Ann"), ("Cyd", "Bob"), ("Bob", "Bob")])
def test_common_neighbours_equal_pairs_of_different_edges(nodes, edges, pair):
    people = {r["id"]: r["name"] for r in nodes.collect()}
    got = graph.common_neighbours(nodes, edges, F.col("name") == pair[0], F.col("name") == pair[1])
    assert {r["id"]: r["matches"] for r in got.collect()} == brute_common(edges, people, *pair)


def test_contacts(nodes, edges):
    got = graph.contacts(
        nodes, edges, F.col("name") == "Ann", F.col("born") >= 1960, F.col("earnings") >= 50
    )
    assert rows(got) == [("Ann", 1970, 60.0)]
    everyone = graph.contacts(nodes, edges, F.col("name") == "Ann", F.lit(True), F.lit(True))
    assert rows(everyone) == [("Bob", 1960, None), ("Bob", 1960, None), ("Ann", 1970, 60.0), ("Cyd", 1959, 5.0)]


def test_average_groups_by_name_and_ignores_missing_pay(nodes, edges):
    got = rows(graph.average_earnings(nodes, edges))
    assert got == [("Bob", None), ("Ann", 30.0), ("Cyd", 5.0)]


def test_rich_groups_by_node(nodes, edges):
    rich = graph.rich(nodes, edges, 29.0)
    assert rows(rich) == [(3, "Ann", 60.0), (1, "Ann", 30.0)]
    assert rows(graph.rich(nodes, edges, -1.0))[-1] == (2, "Bob", 0.0)
    marked = graph.add_label(nodes, rich.unionByName(rich), "Rich")
    assert marked.count() == nodes.count()
    assert sorted(r["id"] for r in graph.labelled(marked, "Rich").collect()) == [1, 3]
    twice = graph.add_label(marked, rich, "Rich")
    assert twice.where("id = 1").first()["labels"] == ["Person", "Rich"]


def test_set_property(nodes):
    got = graph.set_property(nodes, F.col("name") == "Ann", "birthplace", "Rome")
    assert sorted(r["id"] for r in got.where("birthplace = 'Rome'").collect()) == [1, 3]
    assert got.where("birthplace IS NULL").count() == nodes.count() - 2


def test_create_makes_a_second_node_of_the_name(nodes, edges):
    more, linked = graph.create_path(nodes, edges, {"name": "Bob"}, {"title": "New"}, {"roles": "x"})
    assert more.where("name = 'Bob'").count() == 2
    assert linked.count() == edges.count() + 1
    got = graph.out_neighbours(more, linked, F.col("name") == "Bob")
    assert sorted(r["title"] for r in got.collect()) == ["New", "Sea", "Sky"]


def test_merge_edges(spark, nodes):
    seen = spark.createDataFrame(
        [(1, 11, "VIEWED", 4, "k"), (2, 12, "VIEWED", 1, "k"), (2, 11, "OTHER", 9, "k")],
        "src long, dst long, type string, views long, note string",
    )
    asked = spark.createDataFrame(
        [("Ann", "Sea"), ("Bob", "Sea"), ("Bob", "Sea"), ("Nobody", "Sea")], "person string, movie string"
    )
    pairs = graph.resolve(nodes, asked)
    # Two Anns and two Seas make four pairs.
    assert pairs.count() == 4 + 2 * 2
    got = {(r["src"], r["dst"], r["type"]): (r["views"], r["note"]) for r in graph.merge_edges(seen, pairs).collect()}
    assert got == {
        (1, 11, "VIEWED"): (5, "k"),
        (1, 13, "VIEWED"): (1, None),
        (3, 11, "VIEWED"): (1, None),
        (3, 13, "VIEWED"): (1, None),
        (2, 11, "VIEWED"): (2, None),
        (2, 13, "VIEWED"): (2, None),
        (2, 12, "VIEWED"): (1, "k"),
        (2, 11, "OTHER"): (9, "k"),
    }


def test_adjacency(spark):
    lines = spark.createDataFrame([("1 2 3 ",), ("2 1",), ("1 4",), ("9",), ("4 1 ",)], "value string")
    names = spark.createDataFrame([("1", "One"), ("2", "Two"), ("4", "Four")], "id string, name string")
    assert sorted(rows(graph.line_degrees(lines))) == [("1", 1), ("1", 2), ("2", 1), ("4", 1), ("9", 0)]
    assert rows(graph.most_popular(lines, names)) == [("1", "One", 3)]
    # Untrimmed, '4 1 ' has two; the unnamed 9 does not count.
    assert sorted(rows(graph.most_obscure(lines, names))) == [("1", "One", 1), ("2", "Two", 1)]
