"""Pattern queries and changes on the customer-part graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import graph, graph_store
from gristmill.plans import bindings as b
from gristmill.plans.registry import query
from gristmill.session import scratch


def twin(body: str) -> str:
    return f"WITH {b.GRAPH_SQL} {body}"


PLACE = "Lisbon"
TAG = {"title": "Night Shift", "released": 2014, "tagline": "Nobody sleeps"}


@query(twin("""
SELECT id, label, name, title FROM (
    SELECT id, 'Person' AS label, name, NULL AS title FROM persons
    UNION ALL SELECT id, 'Movie', NULL, title FROM movies)
ORDER BY id LIMIT 10"""))
def graph_any_nodes(spark, folder):
    return graph.any_nodes(b.nodes(spark, folder)).select(
        "id", F.array_join("labels", ",").alias("label"), "name", "title"
    )


@query(twin("SELECT title FROM (SELECT id, title FROM movies ORDER BY id LIMIT 10)"))
def graph_label_nodes(spark, folder):
    return graph.any_nodes(b.nodes(spark, folder), "Movie").select("title")


@query(twin(f"""
SELECT p.name FROM acted a JOIN persons p ON a.src = p.id JOIN movies m ON a.dst = m.id
WHERE m.title = '{b.MOVIE}' ORDER BY p.name"""))
def graph_in_neighbours(spark, folder):
    return graph.in_neighbours(
        b.nodes(spark, folder), b.acted_in(spark, folder), F.col("title") == b.MOVIE
    )


OUT = f"""
FROM acted a JOIN persons p ON a.src = p.id JOIN movies m ON a.dst = m.id
WHERE p.name = '{b.PERSON}'"""


@query(twin(f"SELECT m.id, m.title {OUT}"))
def graph_out_neighbours(spark, folder):
    return graph.out_neighbours(
        b.nodes(spark, folder), b.acted_in(spark, folder), F.col("name") == b.PERSON
    )


@query(twin(f"SELECT count(*) AS n {OUT}"))
def graph_out_count(spark, folder):
    found = graph.out_neighbours(
        b.nodes(spark, folder), b.acted_in(spark, folder), F.col("name") == b.PERSON
    )
    return found.agg(F.count(F.lit(1)).alias("n"))


@query(twin(f"""
SELECT m.id, m.title, count(*) AS matches
FROM acted e1 JOIN acted e2 ON e1.dst = e2.dst JOIN movies m ON m.id = e1.dst
JOIN persons p1 ON p1.id = e1.src JOIN persons p2 ON p2.id = e2.src
WHERE p1.name = '{b.PERSON}' AND p2.name = '{b.SECOND_PERSON}' GROUP BY 1, 2"""))
def graph_common(spark, folder):
    return graph.common_neighbours(
        b.nodes(spark, folder),
        b.acted_in(spark, folder),
        F.col("name") == b.PERSON,
        F.col("name") == b.SECOND_PERSON,
    )


@query(twin(f"""
SELECT c.name, c.born, a.earnings
FROM persons t JOIN persons c ON c.nation = t.nation AND c.id <> t.id
JOIN acted a ON a.src = c.id JOIN movies m ON m.id = a.dst
WHERE t.name = '{b.PERSON}' AND c.born >= {b.BORN} AND a.earnings >= {b.ROLE_EARNINGS}
ORDER BY a.earnings DESC"""))
def graph_contacts(spark, folder):
    edges = b.acted_in(spark, folder).unionByName(
        b.contacts_of(spark, folder, b.PERSON), allowMissingColumns=True
    )
    return graph.contacts(
        b.nodes(spark, folder),
        edges,
        F.col("name") == b.PERSON,
        F.col("born") >= b.BORN,
        F.col("earnings") >= b.ROLE_EARNINGS,
    )


@query(twin("""
SELECT p.name, avg(a.earnings) AS average_earnings
FROM acted a JOIN persons p ON a.src = p.id JOIN movies m ON a.dst = m.id
GROUP BY p.name ORDER BY 2 DESC"""))
def graph_avg_edge(spark, folder):
    return graph.average_earnings(b.nodes(spark, folder), b.acted_in(spark, folder))


RICH = f"""
SELECT p.id, p.name, sum(a.earnings) AS total_earnings
FROM acted a JOIN persons p ON a.src = p.id JOIN movies m ON a.dst = m.id
GROUP BY p.id, p.name HAVING sum(a.earnings) > {b.TOTAL_EARNINGS}"""


@query(twin(f"{RICH} ORDER BY total_earnings DESC"))
def graph_rich(spark, folder):
    return graph.rich(b.nodes(spark, folder), b.acted_in(spark, folder), b.TOTAL_EARNINGS)


@query(twin(f"""
SELECT id, CASE WHEN id IN (SELECT id FROM ({RICH})) THEN 'Person,Rich' ELSE 'Person' END
           AS labels FROM persons
UNION ALL SELECT id, 'Movie' FROM movies"""))
def graph_add_label(spark, folder):
    nodes = b.nodes(spark, folder)
    chosen = graph.rich(nodes, b.acted_in(spark, folder), b.TOTAL_EARNINGS)
    return graph.add_label(nodes, chosen, "Rich").select(
        "id", F.array_join("labels", ",").alias("labels")
    )


@query(twin(f"""
SELECT id, name, CASE WHEN name = '{b.PERSON}' THEN '{PLACE}' END AS birthplace FROM persons
UNION ALL SELECT id, NULL, NULL FROM movies"""))
def graph_set_prop(spark, folder):
    changed = graph.set_property(
        b.nodes(spark, folder), F.col("name") == b.PERSON, "birthplace", PLACE
    )
    return changed.select("id", "name", "birthplace")


@query(twin(f"""
, top AS (SELECT max(id) AS id FROM (SELECT id FROM persons UNION ALL SELECT id FROM movies))
SELECT n.id, n.name, n.title, count(e.src) AS edges FROM (
    SELECT id, name, NULL AS title FROM persons
    UNION ALL SELECT id, NULL, title FROM movies
    UNION ALL SELECT id + 1, '{b.PERSON}', NULL FROM top
    UNION ALL SELECT id + 2, NULL, '{TAG["title"]}' FROM top) n
LEFT JOIN (SELECT src FROM acted UNION ALL SELECT id + 1 FROM top) e ON e.src = n.id
GROUP BY 1, 2, 3"""))
def graph_create(spark, folder):
    """All nodes after the insert, with their number of outgoing edges."""
    nodes, edges = graph.create_path(
        b.nodes(spark, folder),
        b.acted_in(spark, folder),
        {"name": b.PERSON},
        TAG,
        {"roles": "Night Shift"},
    )
    degree = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("edges"))
    return nodes.join(degree, "id", "left").select(
        "id", "name", "title", F.coalesce("edges", F.lit(0)).alias("edges")
    )


@query(twin(f"""
, asked AS (
    SELECT p.id AS src, m.id AS dst FROM persons p, movies m
    WHERE p.name = '{b.PERSON}' AND m.title = '{b.MOVIE}')
SELECT COALESCE(v.src, q.src) AS src, COALESCE(v.dst, q.dst) AS dst,
       COALESCE(v.views, 0) + CASE WHEN q.src IS NULL THEN 0 ELSE 1 END AS views
FROM viewed v FULL JOIN asked q ON v.src = q.src AND v.dst = q.dst"""))
def graph_merge_edge(spark, folder):
    """All VIEWED edges after one person viewed every movie of one title."""
    request = spark.createDataFrame([(b.PERSON, b.MOVIE)], "person string, movie string")
    pairs = graph.resolve(b.nodes(spark, folder), request)
    return graph.merge_edges(b.viewed(spark, folder), pairs).select("src", "dst", "views")


def _stored(spark, folder):
    """The graph as a store: nodes, and acting and viewing edges with all their properties."""
    views = b.viewed(spark, folder).withColumn("roles", F.lit(None).cast("array<string>"))
    acting = b.acted_in(spark, folder).select("src", "dst", "type").distinct()
    edges = views.unionByName(acting, allowMissingColumns=True)
    return graph_store.create(spark, scratch(spark, "graph"), b.nodes(spark, folder), edges, buckets=16)


@query(twin(f"""
, asked AS (
    SELECT p.id AS src, m.id AS dst FROM persons p, movies m
    WHERE p.name = '{b.PERSON}' AND m.title = '{b.MOVIE}')
SELECT COALESCE(v.src, q.src) AS src, COALESCE(v.dst, q.dst) AS dst,
       COALESCE(v.views, 0) + CASE WHEN q.src IS NULL THEN 0 ELSE 2 END AS views
FROM viewed v FULL JOIN asked q ON v.src = q.src AND v.dst = q.dst"""))
def graph_stored_merge(spark, folder):
    """All VIEWED edges of a stored graph after one person viewed every movie of one title twice;
    each time only the buckets of those pairs are rewritten."""
    store = _stored(spark, folder)
    request = spark.createDataFrame([(b.PERSON, b.MOVIE)], "person string, movie string")
    for _ in range(2):
        graph_store.merge_edges(store, graph.resolve(store.table(graph_store.NODES), request))
    return store.table(graph_store.EDGES).where("type = 'VIEWED'").select("src", "dst", "views")


@query(twin(f"""
, top AS (SELECT max(id) AS id FROM (SELECT id FROM persons UNION ALL SELECT id FROM movies))
, all_nodes AS (
    SELECT id, 'Person' AS labels, name, NULL AS title FROM persons
    UNION ALL SELECT id, 'Movie', NULL, title FROM movies
    UNION ALL SELECT id + 1, 'Person', '{b.PERSON}', NULL FROM top
    UNION ALL SELECT id + 2, 'Movie', NULL, '{TAG["title"]}' FROM top)
SELECT n.id, CASE WHEN n.id IN (SELECT id FROM ({RICH})) THEN 'Person,Rich' ELSE labels END AS labels, name, title,
       CASE WHEN name = '{b.PERSON}' THEN '{PLACE}' END AS birthplace,
       CASE WHEN n.id = t.id + 1 THEN '["Night Guard","Himself"]' END AS roles
FROM all_nodes n, top t"""))
def graph_stored_changes(spark, folder):
    """All nodes of a stored graph after a new path, a property and a label, with the list of roles of
    the new edge at the node it starts from."""
    store = _stored(spark, folder)
    rich = graph.rich(b.nodes(spark, folder), b.acted_in(spark, folder), b.TOTAL_EARNINGS)
    graph_store.create_path(store, {"name": b.PERSON}, TAG, {"roles": ["Night Guard", "Himself"]})
    graph_store.set_property(store, F.col("name") == b.PERSON, "birthplace", PLACE)
    graph_store.add_label(store, rich, "Rich")
    roles = store.table(graph_store.EDGES).where("roles IS NOT NULL").select(F.col("src").alias("id"), F.to_json("roles").alias("roles"))
    nodes = store.table(graph_store.NODES).join(roles, "id", "left")
    return nodes.select("id", F.array_join("labels", ",").alias("labels"), "name", "title", "birthplace", "roles")


FIRST_WORD = "split_part(value, ' ', 1)"


@query(f"""
SELECT h.id, h.name, connections FROM (
    SELECT split_part(trim(value), ' ', 1) AS id,
           CAST(sum(len(string_split(trim(value), ' ')) - 1) AS BIGINT) AS connections
    FROM ({b.ADJACENCY_SQL}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1) t
JOIN ({b.HERO_SQL}) h ON h.id = t.id""")
def most_popular(spark, folder):
    return graph.most_popular(b.adjacency(spark, folder), b.heroes(spark, folder))


@query(f"""
WITH d AS (
    SELECT h.id, h.name, CAST(len(string_split(value, ' ')) - 1 AS INTEGER) AS connections
    FROM ({b.ADJACENCY_SQL}) JOIN ({b.HERO_SQL}) h ON h.id = {FIRST_WORD})
SELECT * FROM d WHERE connections = (SELECT min(connections) FROM d)""")
def most_obscure(spark, folder):
    return graph.most_obscure(b.adjacency(spark, folder), b.heroes(spark, folder))
