from __future__ import annotations

import random

from gristmill.llm import jaccard_join as jj
from gristmill.llm.components import components


def brute(rows):
    """(class id, class size, links, copies) per id, by comparing all sets."""
    sets = {}
    for i, text in rows:
        words = jj.WORD.findall((text or "").lower())
        n = max(1, len(words) - 4)
        sets[i] = frozenset(tuple(words[k : k + 5]) for k in range(n)) if words else None
    distinct = {s for s in sets.values() if s}
    near = {s: {t for t in distinct if t != s and len(s & t) >= 0.8 * len(s | t)} for s in distinct}
    out, root = {}, {}
    for s in distinct:
        if s not in root:
            group, todo = {s}, [s]
            while todo:
                for t in near[todo.pop()] - group:
                    group.add(t)
                    todo.append(t)
            root.update(dict.fromkeys(group, frozenset(group)))
    for i, s in sets.items():
        if s is None:
            out[i] = (i, 1, 0, 0)
        else:
            ids = [j for j, t in sets.items() if t in root[s]]
            out[i] = (min(ids), len(ids), len(near[s]), sum(t == s for t in sets.values()) - 1)
    return out


def texts():
    draw = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(12):
        words = draw.choices(vocabulary, k=draw.choice((6, 40, 150)))
        for _ in range(draw.choice((1, 2, 9))):
            copy = list(words)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    rows += [(100, rows[0][1].upper() + "!"), (101, ""), (102, None), (103, "one two"), (104, "One, two"), (105, "...")]
    rows.append((106, " ".join(draw.choices(vocabulary, k=20_000))))
    return rows


def found(df):
    return {r.doc_id: (r.class_id, r.class_size, r.n_links, r.n_copies) for r in df.collect()}


def test_against_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, text string, node string, sig string")
    assert found(jj.jaccard_join(docs)) == brute(rows)


def test_blocks_give_the_same(spark, monkeypatch):
    rows = texts()
    monkeypatch.setattr(jj, "BLOCK_SHINGLES", 200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(jj.jaccard_join(docs)) == brute(rows)


def test_a_large_cloud_of_near_copies(spark):
    draw = random.Random(9)
    words = [f"x{i}" for i in range(200)]
    rows = []
    for i in range(300):
        copy = list(words)
        for _ in range(draw.randint(0, 6)):
            copy[draw.randrange(200)] = f"y{draw.randrange(10_000)}"
        rows.append((i, " ".join(copy)))
    assert found(jj.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_repeats_nulls_and_empty_tables(spark):
    long = " ".join(f"v{i}" for i in range(30))
    rows = [(5, long, 1), (5, long, 2), (None, long, 3), (7, long, 4), (None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __x int")
    out = jj.jaccard_join(docs).collect()
    assert len(out) == 5
    assert {r.class_id for r in out if r.doc_id is not None} == {5}
    kept = jj.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect() if r.text) == [(5, long)]
    assert jj.jaccard_join(docs.where("false")).count() == 0


def test_one_of_each_class_without_or_with_a_repeated_id(spark):
    words = [f"v{i}" for i in range(80)]
    near = lambda p, i: " ".join([f"{p}{w}" for w in words] + [f"end{i}"])
    rows = [(None, near("a", i)) for i in range(3)] + [(5, near("b", i)) for i in range(3)]
    rows += [(5, near("c", 0)), (6, near("c", 1)), (None, near("c", 2)), (None, near("d", 0)), (None, near("d", 0))]
    kept = jj.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text[0]) for r in kept) == [(0, "a"), (0, "d"), (5, "b"), (5, "c")]


def test_depth_shortens_to_the_recall():
    assert jj.match_depth(0.8, 32, 8, 0.9999) == 6
    assert jj.match_depth(0.95, 32, 8, 0.9999) == 8


def test_components(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (7, 3)]
    draw.shuffle(edges)
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
