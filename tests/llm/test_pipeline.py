"""The pipeline on a small fixture, against the stages' rules applied by plain Python."""

from __future__ import annotations

import random

import corpus_pipeline as cp
from gristmill.llm import jaccard_join, pieces, secret_scan, sentencepieces
from tests.llm.test_jaccard_join import brute

EN = "the house and river with water that was garden another town street people work under great".split()
FR = "le jardin maison avec une rivière qui était dans ville quelque autre rue gens travail sous grand".split()


def fixture(folder, spark):
    draw = random.Random(11)
    say = lambda words, n: " ".join(draw.choices(words, k=n))
    items = [(0, say(EN, 40)), (1, say(FR, 60)), (2, None)]
    rows = [(i, say(EN if i % 2 else FR, 60 + i), "en" if i % 2 else "fr") for i in range(30)]
    copy = rows[4][1].split()
    copy[3] = "changed"
    rows += [
        (100, rows[3][1], "en"),
        (101, " ".join(copy), "fr"),
        (102, say(EN, 30) + " " + items[0][1] + " " + say(EN, 30), "en"),
        (103, say(EN, 30) + " password=abcdef0123456789xyz " + say(EN, 5), "en"),
        (104, "", None),
        (105, None, "fr"),
        (106, "12345 67890", "en"),
        (None, say(FR, 50), None),
        (3, rows[3][1], "en"),
    ]
    docs = [(i, t, lang, "s", len(t or "")) for i, t, lang in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet"
    )
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_stages_against_plain_python(spark, tmp_path):
    folder = str(tmp_path)
    rows = fixture(folder, spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for n, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
        kept[name] = docs
        assert n == len(cp.STAGES) - 1 or docs.columns == columns
    ids = lambda df: sorted(r.doc_id if r.doc_id is not None else -1 for r in df.collect())
    named = [(i if i is not None else -1, t) for i, t, _ in rows if t and any(c.isalpha() for c in t)]
    assert ids(kept["language_id"]) == sorted(i for i, _ in named)
    classes = brute(named)
    single = sorted({i for i, c in classes.items() if c[0] == i})
    assert 100 not in single and 101 not in single
    assert ids(kept["jaccard_join"]) == single
    left = [i for i in single if i != 102]
    assert ids(kept["decontamination"]) == left == ids(kept["secret_scans"])
    texts = {r.doc_id: r for r in kept["secret_scans"].collect()}
    assert "[REDACTED]" in texts[103].text and texts[103].n_chars == len(texts[103].text)
    vocabulary = pieces.vocabulary(pieces.read_model(pieces.default_path()))
    for row in docs.collect():
        text = texts[row.doc_id].text
        assert secret_scan.find_spans(text) == []
        assert row.round_trip and row.ids == list(sentencepieces.encode(vocabulary, text))
    assert cp.run(spark, folder).count() == len(left)


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
    assert jaccard_join.WIDTH == 5 and jaccard_join.THRESHOLD == 0.8
