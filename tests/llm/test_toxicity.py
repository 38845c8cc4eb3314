from __future__ import annotations

import itertools
import random

import numpy as np

from gristmill.llm import toxicity as tx


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_is_the_edit_distance_to_a_beginning():
    stems = ["idiot", "worthless", "moron", "wormhole", "scum"]
    automaton = tx.StemAutomaton(tx.StemTrie(stems))
    draw = random.Random(1)
    words = {"".join(w) for n in (4, 5, 6) for w in itertools.islice(itertools.product("idot", repeat=n), 900)}
    for stem in stems:
        for _ in range(300):
            word = list(stem + draw.choice(("", "s", "ing")))
            for _ in range(draw.randint(0, 2)):
                at = draw.randrange(len(word))
                word[at : at + draw.randint(0, 1)] = draw.choice(("", "a", "x", stem[0]))
            words.add("".join(word))
    for word in words:
        want = None
        for stem in stems:
            for n in range(1, len(word) + 1):
                d = distance(word[:n], stem)
                allowed = 1 if len(stem) >= tx.FUZZY and word[0] == stem[0] else 0
                # The edit lies inside the stem: an extra letter counts before the stem's end only.
                if d <= allowed and (want is None or d < want):
                    want = d
        assert automaton.match(word) == want, word


def test_context_tells_quotation_from_abuse():
    reader = tx.Reader(["worthless"])
    open_, quoted, reported = (
        reader.features(t)
        for t in ("you worthless thing", 'the text "worthless thing" is here', "he said worthless to them")
    )
    assert open_[0] > 0 and open_[2] == 0 and open_[3] > 0
    assert quoted[0] == 0 and quoted[2] > 0
    assert reported[0] == 0 and reported[2] > 0
    assert reader.features("wortless")[1] > 0
    assert reader.features(None) == reader.features("") == [0.0] * tx.FEATURES
    assert reader.features("plain " * 50_000) == [0.0] * tx.FEATURES


def test_logistic_separates():
    x = np.array([[0.0], [0.2], [0.8], [1.0]] * 20)
    y = np.array([0, 0, 1, 1] * 20, float)
    w = tx.logistic(x, y)
    assert w[0] > 0 and w[0] * 0.1 + w[1] < 0 < w[0] * 0.9 + w[1]


def test_rows_with_nulls_repeats_and_clashing_names(spark):
    draw = random.Random(2)
    plain = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(120):
        words = draw.choices(plain, k=20)
        if i % 4 == 0:
            words[draw.randrange(20)] = "idiotic"
        rows.append((i, " ".join(words), "s", "k"))
        labels.append((i, int(i % 4 == 0), 9))
    rows += [(None, "idiotic", None, None), (500, None, None, None), (501, "", None, None), (0, rows[0][1], "s", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, _key string")
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, None, 1)], "doc_id long, toxic int, text int")
    model = tx.fit(docs, marks)
    out = tx.score(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in out if r.doc_id is not None and r.doc_id < 500)
    assert all(r.score < 0.5 for r in out if r.doc_id in (500, 501))
    nothing = tx.fit(docs, marks.where("false"))
    assert {r.score for r in tx.score(docs, nothing).collect()}.pop() < 0.5
    assert tx.score(docs.where("false"), model).count() == 0


def test_held_out_quality(spark):
    from gristmill.llm.queries import LLM_QUERIES

    folder = "/root/testdata/sf0.1"
    out = LLM_QUERIES["op1_toxicity"].run(spark, folder).where("held_out")
    rows = out.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("score", "toxic").collect()
    bad = [r.score for r in rows if r.toxic == 1]
    fine = [r.score for r in rows if r.toxic == 0]
    better = sum((b > f) + 0.5 * (b == f) for b in bad for f in fine)
    assert better / (len(bad) * len(fine)) > 0.93
    assert sum(f >= 0.5 for f in fine) <= 0.01 * len(fine)


def test_a_fitted_model_finds_misspellings_and_spares_shared_beginnings(spark):
    draw = random.Random(5)
    plain = [f"{a}{b}{c}" for a in ("ba", "ne", "ri", "vo") for b in ("lan", "mer", "tos") for c in ("da", "ge", "ku")]
    toxic = ["idiot", "worthless", "scum", "disgusting", "pathetic"]
    rows, labels = [], []
    for i in range(400):
        words = draw.choices(plain, k=20)
        if i % 4 == 0:
            words[draw.randrange(20)] = toxic[i // 4 % 5]
        elif i % 4 == 1:
            words[draw.randrange(20)] = "slum"  # one edit from a toxic word, and ordinary
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    model = tx.fit(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    )
    assert model.stems == sorted(toxic)
    bad = ["1diot", "w0rthless", "scvm", "dsgusting", "xathetic", "idiots", "scum"]
    fine = ["idioma", "wording", "disguise", "pathology", "slum"]
    asked = [(i, " ".join(draw.choices(plain, k=19) + [w])) for i, w in enumerate(bad + fine)]
    out = tx.score(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()
    assert {(bad + fine)[r.doc_id] for r in out if r.score >= 0.5} == set(bad)


def test_rare_forms_are_joined_to_their_longest_beginning():
    counts = {"path": (9, 0), "pathe": (9, 0), "pathet": (9, 0), "pathetics": (4, 0), "lose": (8, 0), "loser": (7, 0)}
    counts |= {"loser$": (7, 0), "loses": (1, 3)}
    assert tx.choose_stems(counts, 20, 200) == ["loser", "pathet"]
