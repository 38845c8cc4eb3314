"""Token counts and SentencePiece ids against the public unigram tokenizer and a full Viterbi."""

from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer, models

from gristmill.llm import pieces, sentencepieces, token_counts

MODEL = pieces.read_model(pieces.default_path())
V = pieces.vocabulary(MODEL)
LIBRARY = Tokenizer(
    models.Unigram([(p, V.plain.get(p, (-3e9, 0))[0]) for p in V.pieces], unk_id=0, byte_fallback=True)
)
TEXTS = [
    "a",
    "the other there",
    "a  b\n\tc é 😀 x",
    "  lead",
    "trail  ",
    "\n\n",
    "😀😀" * 40 + "abc" * 300,
    "x" * 5000,
    " " * 70,
    "Licensed under the Apache License, Version 2.0.\nÜber çñ 梦 執",
]


def marked(text: str) -> str:
    return pieces.SPACE + text.replace(" ", pieces.SPACE)


@pytest.mark.parametrize("text", TEXTS)
def test_as_the_public_tokenizer(text):
    ids = LIBRARY.encode(marked(text)).ids
    assert list(sentencepieces.encode(V, text)) == ids
    assert token_counts.count_text(V, text, {}) == len(ids)
    assert sentencepieces.decode(V, ids) == text


def test_random_texts_stream_count_and_round_trip():
    draw = random.Random(3)
    for _ in range(300):
        text = "".join(draw.choice("abehirt  \nété😀.1") for _ in range(draw.randint(1, 200)))
        ids = LIBRARY.encode(marked(text)).ids
        runs = list(sentencepieces.stream_ids(V, marked(text)))
        assert [i for run in runs for i in run] == ids == list(sentencepieces.encode(V, text))
        assert token_counts.count_text(V, text, {}) == len(ids)
        assert sentencepieces.decode(V, ids) == text


def test_a_stream_commits_early_and_keeps_a_small_window():
    runs = list(sentencepieces.stream_ids(V, "the" * 3000))
    assert len(runs) > 100 and max(map(len, runs)) < 100


def test_ties_go_to_the_longer_last_piece():
    # Full Viterbi over all segmentations of short words, by brute force with the same rule.
    def best(text):
        cells = [(0.0, [])]
        for end in range(1, len(text) + 1):
            found = None
            for start in range(max(0, end - V.longest), end):
                piece = text[start:end]
                if piece in V.plain:
                    score, i = V.plain[piece]
                    total = cells[start][0] + score
                    if found is None or total > found[0]:
                        found = (total, cells[start][1] + [i])
            if text[end - 1] not in V.plain:
                total = cells[end - 1][0] + V.unknown
                if found is None or total > found[0]:
                    found = (total, cells[end - 1][1] + list(V.fallback(text[end - 1])))
            cells.append(found)
        return cells[-1][1]

    draw = random.Random(5)
    for _ in range(200):
        text = "▁" + "".join(draw.choice("aehnorst") for _ in range(draw.randint(1, 12)))
        assert best(text) == [i for run in sentencepieces.stream_ids(V, text) for i in run]


def test_columns_nulls_and_clashing_names(spark):
    schema = "doc_id long, text string, n_tokens string, ids string, _key string"
    rows = [(1, "the other", "x", "y", "z"), (None, None, None, None, None), (2, "", "", "", ""), (1, "the other", "x", "y", "z")]
    docs = spark.createDataFrame(rows, schema)
    counted = sorted(token_counts.token_counts(docs, MODEL).collect(), key=str)
    n = len(sentencepieces.encode(V, "the other"))
    assert sorted((r.doc_id or 0, r.n_tokens) for r in counted) == [(0, 0), (1, n), (1, n), (2, 0)]
    coded = sentencepieces.encode_documents(docs, MODEL)
    found = {(r.doc_id, r.n_ids, r.round_trip) for r in coded.collect()}
    assert found == {(1, n, True), (None, 0, True), (2, 0, True)}
    back = coded.select(sentencepieces.decode_column(coded.ids, MODEL).alias("t")).collect()
    assert sorted(r.t for r in back) == ["", "", "the other", "the other"]
    empty = docs.where("false")
    assert token_counts.token_counts(empty, MODEL).count() == 0
    assert sentencepieces.encode_documents(empty, MODEL).count() == 0


def test_query_returns_the_ids(spark, tmp_path):
    from gristmill.llm.queries import LLM_QUERIES

    spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in LLM_QUERIES["op5_sentencepiece"].run(spark, str(tmp_path)).collect()}
    vocabulary = pieces.vocabulary(pieces.read_model(pieces.default_path()))
    assert out[1].ids == list(sentencepieces.encode(vocabulary, "some words")) and out[1].n_ids == len(out[1].ids)
