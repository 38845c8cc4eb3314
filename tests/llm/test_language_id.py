from __future__ import annotations

import itertools
import random

import numpy as np

from gristmill.llm import language_id as li

EN = "the house and the river with water that was in the garden of another town"
FR = "le jardin et la maison avec une rivière qui était dans la ville de quelque autre"
RU = "дом и река с водой которая была в саду другого города"


def corpus(spark):
    draw = random.Random(1)
    rows = []
    for i in range(60):
        lang, base = ("en", EN) if i % 3 == 0 else ("fr", FR) if i % 3 == 1 else ("ru", RU)
        words = base.split()
        rows.append((i, " ".join(draw.choices(words, k=30)), lang, "x", "y"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, _key string")


def test_viterbi_is_the_best_of_all_label_sequences():
    draw = np.random.default_rng(2)
    texts = [draw.normal(0, 10, (n, 3)) for n in (1, 5, 0, 7, 3)]
    for scores, labels in zip(texts, li.label_words(texts), strict=True):
        def value(seq, scores=scores):
            return sum(s[x] for s, x in zip(scores, seq, strict=True)) - li.SWITCH * sum(
                a != b for a, b in itertools.pairwise(seq)
            )
        best = max(itertools.product(range(3), repeat=len(scores)), key=value)
        assert np.isclose(value(best), value(labels.tolist()))


def test_languages_spans_and_defined_cases(spark):
    docs = corpus(spark)
    model = li.fit(docs)
    assert model.languages == ("en", "fr", "ru")
    mixed = f"{EN}. {FR} {RU}"
    rows = [(1, EN), (2, FR), (3, RU), (4, mixed), (5, ""), (6, None), (7, "123 !?"), (None, EN), (1, EN), (8, EN * 2000), (9, "漢字")]
    asked = spark.createDataFrame(rows, "doc_id long, text string")
    out = li.identify(asked, model).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (1, 2, 3, None, 8)] == ["en", "fr", "ru", "en", "en"]
    assert all(by[i].lang_pred == "und" and by[i].score == 0.0 and by[i].spans == [] for i in (5, 6, 7))
    assert [x.lang for x in by[4].spans] == ["en", "fr", "ru"]
    for span, part in zip(by[4].spans, (EN, FR, RU), strict=True):
        assert mixed[span.start : span.end] == part
    assert by[9].lang_pred in model.languages
    columns = asked.select(li.label_column(asked.text, model).alias("x")).where("x.lang_pred = 'und'").count()
    assert columns == 3


def test_nothing_to_learn_from(spark):
    empty = corpus(spark).where("false")
    model = li.fit(empty)
    out = li.identify(spark.createDataFrame([(1, EN)], "doc_id long, text string"), model).collect()
    assert (out[0].lang_pred, out[0].score) == ("und", 0.0)
    assert li.identify(empty, model).count() == 0


def test_held_out_accuracy(spark):
    from gristmill.llm.queries import LLM_QUERIES

    folder = "/root/testdata/sf0.01"
    out = LLM_QUERIES["op6_language_id"].run(spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    held = out.where("held_out").join(truth, "doc_id")
    assert held.where("lang_pred = lang").count() >= 0.99 * held.count()
