"""Removed words against counting every window, and the defined cases."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from gristmill.llm import substring_dedup as dedup


def plain(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def run(spark, texts, window, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    docs = docs.withColumn("_chunk", docs.text).withColumn("n_words", docs.doc_id)  # names of its own
    found = dedup.remove_repeats(docs, window=window, keep_text=True, **options).collect()
    assert all(r["kept_sha256"] == hashlib.sha256(r["kept"].encode()).hexdigest() for r in found)
    return [(r["n_words"], r["n_removed"], r["kept"]) for r in sorted(found, key=lambda r: r["doc_id"])]


def random_texts(seed: int, n: int) -> list[str]:
    """Short vocabularies, so that windows of every kind of overlap repeat."""
    draw = random.Random(seed)
    passages = [[draw.choice("abcd") for _ in range(draw.randint(3, 30))] for _ in range(6)]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(draw.randint(0, 4)):
            words += [draw.choice("abcdefghij") + str(draw.randint(0, 9)) for _ in range(draw.randint(0, 12))]
            passage = draw.choice(passages)
            a = draw.randint(0, len(passage))
            words += passage[a:]
        texts.append(draw.choice([" ", "\n", "  \t"]).join(words))
    return texts


@pytest.mark.parametrize(("window", "seed"), [(5, 1), (6, 2), (9, 3)])
def test_random_texts_as_counted(spark, window, seed):
    texts = random_texts(seed, 80)
    expected = plain(texts, window)
    assert run(spark, texts, window) == expected
    assert any(n for _, n, _ in expected)
    # Tiny chunks: every repeat is found between chunks.
    assert run(spark, texts, window, chunk_bytes=1) == expected


def test_production_window_at_every_offset(spark):
    draw = random.Random(4)
    filler = iter(f"w{i}" for i in range(10_000))
    passage = [f"p{i}" for i in range(35)]
    texts = []
    for offset in range(20):
        texts.append(" ".join([*(next(filler) for _ in range(offset)), *passage, next(filler)]))
    texts.append(" ".join(passage[:34]))
    draw.shuffle(texts)
    expected = plain(texts, 35)
    assert [n for _, n, _ in expected].count(35) == 20
    assert run(spark, texts, 35) == expected


def test_defined_cases(spark):
    long = " ".join(f"x{i % 700}" for i in range(3_000))  # repeats inside one text
    huge_word = "ab" * 70_000
    texts = [None, "", "   \n", "one two", "é" * 3, long, huge_word, " ".join([huge_word] * 4), "a\x0bb\x0cc\rd\te"]
    assert run(spark, texts, 3) == plain(texts, 3)
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert dedup.remove_repeats(empty).count() == 0


def test_repeated_rows_and_null_ids_are_occurrences(spark):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (7, "a b c d x"), (7, "q r s t u")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = dedup.remove_repeats(docs, window=4, keep_text=True).collect()
    assert sorted((str(r["doc_id"]), r["kept"]) for r in found) == [
        ("7", "q r s t u"),
        ("7", "x"),
        ("None", ""),
        ("None", ""),
    ]


def test_words_longer_than_the_factor_table_differ_by_place():
    size = dedup.REACH
    one, two = "a" + "b" * (size - 1) + "c" + "b" * size, "c" + "b" * (size - 1) + "a" + "b" * size
    words = dedup.Words.of([one, two])
    assert len(set(words.hashes(0).tolist())) == 2


def test_at_most_twice_keeps_two_of_each():
    values = np.array([5, 1, 5, 5, 2, 1, 5], dtype=np.uint64)
    assert sorted(values[dedup.at_most_twice(values)].tolist()) == [1, 1, 2, 5, 5]
    low = np.array([0, 0, 0, 1, 0], dtype=np.uint64)
    high = np.array([3, 3, 3, 3, 3], dtype=np.uint64)
    assert len(dedup.at_most_twice(low, high)) == 3
