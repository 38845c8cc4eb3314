"""Pattern queries and changes on a property graph.

``nodes``: id, labels array<string> and property columns (name, title, born ...).
``edges``: src, dst, type and property columns (earnings, views ...).
Matches are counted per pattern row, so parallel edges count once each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text


def labelled(nodes: DataFrame, label: str) -> DataFrame:
    return nodes.where(F.array_contains("labels", label))


def typed(edges: DataFrame, kind: str) -> DataFrame:
    return edges.where(F.col("type") == kind)


def any_nodes(nodes: DataFrame, label: str | None = None, k: int = 10) -> DataFrame:
    """k nodes, of one label if given; the smallest ids, to be repeatable."""
    found = labelled(nodes, label) if label else nodes
    return found.orderBy("id").limit(k)


def in_neighbours(
    nodes: DataFrame,
    edges: DataFrame,
    into: Column,
    source: str = "Person",
    target: str = "Movie",
    kind: str = "ACTED_IN",
) -> DataFrame:
    """Names of the nodes with an edge into the nodes that pass ``into``."""
    ends = labelled(nodes, target).where(into).select(F.col("id").alias("dst"))
    hits = typed(edges, kind).join(ends, "dst").select("src", "dst")
    people = labelled(nodes, source).select(F.col("id").alias("src"), "name")
    return hits.join(people, "src").orderBy("name", "src", "dst").select("name")


def out_neighbours(
    nodes: DataFrame,
    edges: DataFrame,
    out_of: Column,
    source: str = "Person",
    target: str = "Movie",
    kind: str = "ACTED_IN",
) -> DataFrame:
    """Ids and titles the nodes that pass ``out_of`` have an edge to."""
    starts = labelled(nodes, source).where(out_of).select(F.col("id").alias("src"))
    hits = typed(edges, kind).join(starts, "src").select("dst")
    ends = labelled(nodes, target).select(F.col("id").alias("dst"), "title")
    return hits.join(ends, "dst").select(F.col("dst").alias("id"), "title")


def common_neighbours(
    nodes: DataFrame,
    edges: DataFrame,
    first: Column,
    second: Column,
    source: str = "Person",
    target: str = "Movie",
    kind: str = "ACTED_IN",
) -> DataFrame:
    """Targets both node sets point to, with the number of pattern rows.

    A pattern row is a pair of different edges, one from each set. The pairs are
    counted per target (edges of the first times edges of the second, less the
    edges that would pair with themselves), never built.
    """
    starts = (
        labelled(nodes, source)
        .where(first | second)
        .select(
            F.col("id").alias("src"),
            F.coalesce(first, F.lit(False)).cast("long").alias("a"),
            F.coalesce(second, F.lit(False)).cast("long").alias("b"),
        )
    )
    per_target = (
        typed(edges, kind).join(starts, "src")
        .groupBy("dst")
        .agg(
            (F.sum("a") * F.sum("b") - F.sum(F.col("a") * F.col("b"))).alias("matches")
        )
        .where("matches > 0")
    )
    ends = labelled(nodes, target).select(F.col("id").alias("dst"), "title")
    return per_target.join(ends, "dst").select(F.col("dst").alias("id"), "title", "matches")


def contacts(
    nodes: DataFrame,
    edges: DataFrame,
    of: Column,
    contact: Column,
    role: Column,
) -> DataFrame:
    """Contacts of the nodes that pass ``of``, with each of their roles that
    passes ``role``; best paid first."""
    people = labelled(nodes, "Person")
    starts = people.where(of).select(F.col("id").alias("src"))
    met = typed(edges, "HAS_CONTACT").join(starts, "src").select(
        F.col("dst").alias("id")
    )
    known = met.join(people.where(contact).select("id", "name", "born"), "id")
    movies = labelled(nodes, "Movie").select(F.col("id").alias("dst"))
    roles = typed(edges, "ACTED_IN").where(role).select(F.col("src").alias("id"), "dst", "earnings")
    return (
        roles.join(known, "id")
        .join(movies, "dst")
        .orderBy(F.col("earnings").desc_nulls_first(), "name", "dst")
        .select("name", "born", "earnings")
    )


def _earnings(nodes: DataFrame, edges: DataFrame, kind: str) -> DataFrame:
    """Per source id: sum and count of the earnings on edges into movies."""
    movies = labelled(nodes, "Movie").select(F.col("id").alias("dst"))
    return (
        typed(edges, kind)
        .join(movies, "dst", "left_semi")
        .groupBy("src")
        .agg(F.sum("earnings").alias("total"), F.count("earnings").alias("paid"))
    )


def average_earnings(nodes: DataFrame, edges: DataFrame, kind: str = "ACTED_IN") -> DataFrame:
    """Average edge earnings per person *name*; unpaid names come first.

    Edges shrink to one row per node before they meet the names.
    """
    people = labelled(nodes, "Person").select(F.col("id").alias("src"), "name")
    return (
        _earnings(nodes, edges, kind)
        .join(people, "src")
        .groupBy("name")
        .agg(F.try_divide(F.sum("total"), F.sum("paid")).alias("average_earnings"))
        .orderBy(F.col("average_earnings").desc_nulls_first(), "name")
    )


def rich(nodes: DataFrame, edges: DataFrame, limit: float, kind: str = "ACTED_IN") -> DataFrame:
    """Persons (by id) whose edge earnings add up to more than the limit."""
    people = labelled(nodes, "Person").select("id", "name")
    totals = _earnings(nodes, edges, kind).select(
        F.col("src").alias("id"),
        F.coalesce("total", F.lit(0.0)).alias("total_earnings"),
    )
    return (
        totals.where(F.col("total_earnings") > limit)
        .join(people, "id")
        .orderBy(F.col("total_earnings").desc(), "id")
        .select("id", "name", "total_earnings")
    )


def add_label(nodes: DataFrame, chosen: DataFrame, label: str) -> DataFrame:
    """Add a label to the nodes whose id is in ``chosen``."""
    marks = chosen.select("id").distinct().withColumn("_hit", F.lit(True))
    return (
        nodes.join(marks, "id", "left")
        .withColumn(
            "labels",
            F.when(
                F.col("_hit"), F.array_union("labels", F.array(F.lit(label)))
            ).otherwise(F.col("labels")),
        )
        .drop("_hit")
    )


def set_property(nodes: DataFrame, match: Column, name: str, value) -> DataFrame:
    """Set a property on the nodes that match; the others keep theirs."""
    old = F.col(name) if name in nodes.columns else F.lit(None)
    return nodes.withColumn(name, F.when(match, F.lit(value)).otherwise(old))


def create_path(
    nodes: DataFrame,
    edges: DataFrame,
    start: dict[str, object],
    end: dict[str, object],
    edge: dict[str, object],
    start_label: str = "Person",
    end_label: str = "Movie",
    kind: str = "ACTED_IN",
) -> tuple[DataFrame, DataFrame]:
    """Create two nodes and the edge between them, whatever is there already: a
    person of a known name becomes a second node of that name."""
    top_id = nodes.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))

    def node(offset: int, label: str, values: dict[str, object]) -> DataFrame:
        return top_id.select(
            (F.col("top") + offset).alias("id"),
            F.array(F.lit(label)).alias("labels"),
            *[F.lit(v).alias(k) for k, v in values.items()],
        )

    new_edge = top_id.select(
        (F.col("top") + 1).alias("src"),
        (F.col("top") + 2).alias("dst"),
        F.lit(kind).alias("type"),
        *[F.lit(v).alias(k) for k, v in edge.items()],
    )
    grown = nodes.unionByName(
        node(1, start_label, start), allowMissingColumns=True
    ).unionByName(node(2, end_label, end), allowMissingColumns=True)
    return grown, edges.unionByName(new_edge, allowMissingColumns=True)


def resolve(nodes: DataFrame, requests: DataFrame) -> DataFrame:
    """(person, movie) names to one (src, dst) row per matching pair of nodes.
    Names nobody bears drop out, shared names match every bearer."""
    people = labelled(nodes, "Person").select(F.col("name").alias("person"), F.col("id").alias("src"))
    movies = labelled(nodes, "Movie").select(F.col("title").alias("movie"), F.col("id").alias("dst"))
    found = people.join(requests, "person").select("src", "movie")
    return movies.join(found, "movie").select("src", "dst")


def merge_edges(edges: DataFrame, pairs: DataFrame, kind: str = "VIEWED") -> DataFrame:
    """Upsert: an existing edge counts one more view per request, a missing one is
    created with one view and counts the repeats of its request on top.

    One full outer join of the edges with the counted requests; a side that turns out
    small is left to adaptive execution.
    """
    wanted = pairs.groupBy(F.col("src").alias("_s"), F.col("dst").alias("_d")).agg(
        F.count(F.lit(1)).alias("_more")
    )
    marked = edges.withColumn("_old", F.lit(True))
    same = (F.col("src") == F.col("_s")) & (F.col("dst") == F.col("_d")) & (F.col("type") == kind)
    met = marked.join(wanted, same, "full_outer")
    new = F.col("_old").isNull()
    changed = {
        "src": F.when(new, F.col("_s")).otherwise(F.col("src")),
        "dst": F.when(new, F.col("_d")).otherwise(F.col("dst")),
        "type": F.when(new, F.lit(kind)).otherwise(F.col("type")),
        "views": F.when(new, F.col("_more"))
        .when(F.col("_more").isNotNull(), F.col("views") + F.col("_more"))
        .otherwise(F.col("views")),
    }
    return met.withColumns(changed).select(*edges.columns)


def line_degrees(lines: DataFrame, value: str = "value", trim: bool = True) -> DataFrame:
    """Id and number of neighbours of each adjacency line ``id n1 n2 ...``.
    Untrimmed, a space at the end counts as a neighbour."""
    line = F.trim(F.col(value)) if trim else F.col(value)
    return lines.select(
        F.substring_index(line, " ", 1).alias("id"),
        text.occurrences(line, " ").alias("connections"),
    )


def most_popular(lines: DataFrame, names: DataFrame) -> DataFrame:
    """The node with most neighbours, summed over its lines, and its name."""
    best = (
        line_degrees(lines)
        .groupBy("id")
        .agg(F.sum("connections").alias("connections"))
        .orderBy(F.col("connections").desc(), "id")
        .limit(1)
    )
    return names.join(F.broadcast(best), "id").select("id", "name", "connections")


def most_obscure(lines: DataFrame, names: DataFrame) -> DataFrame:
    """Named lines with the fewest neighbours, each line on its own.

    Lines shrink to one row per id and number before they meet the names, so an id with
    very many lines is no burden; the rows of the minimum are repeated at the end.
    """
    counted = (
        line_degrees(lines, trim=False).groupBy("id", "connections").agg(F.count(F.lit(1)).alias("_lines"))
    )
    named = counted.join(names, "id")
    fewest = named.agg(F.min("connections")).scalar()
    return (
        named.where(F.col("connections") == fewest)
        .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_lines").cast("int"))))
        .select("id", "name", "connections")
    )
