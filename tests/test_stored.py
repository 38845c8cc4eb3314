"""Stored tables and graphs: touched buckets only, one commit for all, failures unseen."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from gristmill.operators import graph, graph_store
from gristmill.sources.stored import Store

EDGE = "src bigint, dst bigint, type string, views bigint, roles array<string>"
NODE = "id bigint, labels array<string>, name string, title string, birthplace string"


@pytest.fixture
def store(spark, tmp_path):
    nodes = [(i, ["Person"], f"p{i % 40}", None, None) for i in range(50)]
    nodes += [(i, ["Movie"], None, f"m{i}", None) for i in range(50, 80)]
    edges = [(i, 50 + i % 30, "VIEWED", 1, None) for i in range(50)] + [(None, 5, "VIEWED", 7, None)]
    frames = spark.createDataFrame(nodes, NODE), spark.createDataFrame(edges, EDGE)
    return graph_store.create(spark, str(tmp_path / "g"), *frames, buckets=8)


def views(store):
    rows = store.table("edges").where("type = 'VIEWED'").collect()
    return {(r["src"], r["dst"]): r["views"] for r in rows}


def test_merging_twice_counts_two_and_rewrites_only_touched_buckets(spark, store):
    before, old = store.versions("edges"), views(store)
    nodes_before = store.versions("nodes")
    pairs = spark.createDataFrame([(1, 51), (1, 77)], "src bigint, dst bigint")
    hit = {r[0] for r in pairs.select(Store.bucket(["src", "dst"], 8)).collect()}
    for _ in range(2):
        graph_store.merge_edges(store, pairs)
    after = store.versions("edges")
    assert {b for b in after if after[b] != before.get(b)} == hit
    assert store.versions("nodes") == nodes_before
    assert views(store) == old | {(1, 51): old[1, 51] + 2, (1, 77): 2}


def test_the_other_buckets_are_not_read(spark, store):
    plan = store.table("edges", [2])._jdf.queryExecution().toString()
    files = store.table("edges", [2]).inputFiles()
    assert files and all("/bucket=2/" in f for f in files), plan


def test_a_path_with_roles_a_property_and_a_label(spark, store):
    graph_store.create_path(store, {"name": "p3"}, {"title": "New"}, {"roles": ["One", "Two"]})
    edge = store.table("edges").where("type = 'ACTED_IN'").collect()
    assert [(r["src"], r["dst"], r["roles"]) for r in edge] == [(80, 81, ["One", "Two"])]
    graph_store.set_property(store, F.col("name") == "p3", "birthplace", "there")
    placed = store.table("nodes").where("birthplace is not null")
    assert sorted(r["id"] for r in placed.collect()) == [3, 43, 80]
    graph_store.add_label(store, spark.createDataFrame([(3,), (999,)], "id bigint"), "Rich")
    assert [(r["id"], r["labels"]) for r in store.table("nodes").where("size(labels) > 1").collect()] == [(3, ["Person", "Rich"])]
    assert store.table("nodes").count() == 82


def test_a_failed_change_leaves_everything_as_it_was(spark, store):
    before, seen = store.versions("edges"), views(store)

    def broken(rows):
        return rows.withColumn("views", F.raise_error(F.lit("lost")).cast("bigint"))

    nodes = store.change("nodes", spark.createDataFrame([(1,)], "id bigint"), lambda rows: rows.where("id <> 1"))
    pairs = spark.createDataFrame([(1, 51)], "src bigint, dst bigint")
    with pytest.raises(Exception, match="lost"):
        store.commit(nodes, store.change("edges", pairs, broken))
    assert store.versions("edges") == before and views(store) == seen
    assert store.table("nodes").where("id = 1").count() == 1


def test_rows_outside_the_touched_buckets_are_refused(spark, store):
    moved = store.change("nodes", spark.createDataFrame([(1,)], "id bigint"), lambda rows: rows.withColumn("id", F.col("id") + 1))
    with pytest.raises(ValueError, match="outside"):
        store.commit(moved)
    assert store.table("nodes").count() == 80


def test_dropped_rows_empty_buckets_and_vacuum(spark, store, tmp_path):
    everything = store.table("nodes").select("id")
    store.commit(store.change("nodes", everything, lambda rows: rows.where(F.lit(False))))
    assert store.table("nodes").count() == 0 and store.versions("nodes") == {}
    graph_store.create_path(store, {"name": "a"}, {"title": "b"}, {})
    assert sorted(r["id"] for r in store.table("nodes").collect()) == [1, 2]
    edges = views(store)
    assert store.vacuum() > 0 and store.vacuum() == 0
    assert views(store) == edges and store.table("nodes").count() == 2
    kept = [d for d, _, files in os.walk(tmp_path / "g" / "data") if any(f.endswith(".parquet") for f in files)]
    assert len(kept) == len(store.versions("nodes")) + len(store.versions("edges"))


def test_merging_nothing_changes_nothing(spark, store):
    before = store.versions("edges")
    graph_store.merge_edges(store, spark.createDataFrame([], "src bigint, dst bigint"))
    assert store.versions("edges") == before


def test_a_second_store_object_sees_the_last_commit(spark, store):
    pairs = spark.createDataFrame([(2, 52)], "src bigint, dst bigint")
    graph_store.merge_edges(store, pairs)
    again = Store(spark, store.path)
    assert views(again)[2, 52] == 2
    whole = graph.merge_edges(again.table("edges"), pairs)
    assert whole.count() == again.table("edges").count()
