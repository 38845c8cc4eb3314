"""Aligned groups, links and counts against the tokenizers and plain loops over bytes."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gristmill.llm import alignment

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
FILES = alignment.read_files(A_PATH, B_PATH)
PAIR = alignment.tokenizers(*FILES, public_tokenizers.PATTERN)
LIBRARY = Tokenizer.from_file(A_PATH)
LIBRARY.encode_special_tokens = True
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    "Hello world, this is it.",
    "  two  spaces\tand tabs \n",
    "naïve café 日本語 😀 text",
    "<|endoftext|> and </s> are plain",
    "a▁b is not given back",
    "x",
    "a" * 3000,
    "ab " * 500 + "12345 67",
    "tokenization unbelievably misaligned",
    "",
    None,
    "Hello world, this is it.",
]


def plain(texts):
    """The rows of the contract, by loops."""
    found, linked = [], []
    for text in texts:
        ids_a, ids_b = [], []
        if text:
            ids_a = LIBRARY.encode(" " + text, add_special_tokens=False).ids
            ids_b = PAIR.b.model.encode(text)
            data = (" " + text).encode()
            if any(b"".join(t.bytes[i] for i in ids) != data for t, ids in ((PAIR.a, ids_a), (PAIR.b, ids_b))):
                ids_a, ids_b = [], []
        spans = []
        for tokens, ids in ((PAIR.a, ids_a), (PAIR.b, ids_b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(tokens.bytes[i]), i))
                at += len(tokens.bytes[i])
            spans.append(own)
        links = [(a[2], b[2]) for a in spans[0] for b in spans[1] if a[0] < b[1] and b[0] < a[1]]
        ends = sorted({a[1] for a in spans[0]} & {b[1] for b in spans[1]})
        groups, before = [], 0
        for end in ends:
            parts = [",".join(str(i) for s, e, i in own if before <= s and e <= end) for own in spans]
            groups.append("|".join(parts))
            before = end
        found.append((ids_a, ids_b, groups))
        linked.append(links)
    count = collections.Counter(p for links in linked for p in set(links))
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    rows = []
    for i, ((ids_a, ids_b, groups), links) in enumerate(zip(found, linked)):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        top = sum(count[p] == best[p[0]] for p in links)
        total = sum(count[p] for p in links)
        rows.append((i, len(ids_a), len(ids_b), len(groups), len(links), top, total, digest))
    return rows


def run(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs = docs.withColumn("n_a", docs.doc_id).withColumn("pairs", docs.text)  # names of its own
    out = alignment.align_documents(docs, *FILES, public_tokenizers.PATTERN, **options)
    return sorted(tuple(r) for r in out.select(*COLUMNS).collect())


def test_special_texts_as_by_loops(spark):
    assert run(spark, TEXTS) == plain(TEXTS)


def test_random_texts_over_many_batches(spark):
    draw = random.Random(7)
    words = ["the", "unhappily", "été", "日本", "  ", "don't", "1234", "😀", "\n", "x" * 40, "Grüße,"]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 40))) for _ in range(150)]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        assert run(spark, texts) == plain(texts)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_long_texts_in_parts_give_the_same_ids():
    draw = random.Random(5)
    words = ["don't", "stop", "é", "12", "...", "  ", "\n", "Ab", "z,", "日本"]
    for _ in range(100):
        text = " ".join(draw.choice(words) for _ in range(60))
        assert PAIR.encode(text, part=7) == PAIR.encode(text)
        assert PAIR.encode(text)[0] == LIBRARY.encode(" " + text, add_special_tokens=False).ids


def test_pointers_jump_to_the_last_token_of_a_group():
    # A: [0,2) [2,5) [5,6); B: [0,3) [3,5) [5,6). The first four tokens are one group.
    pointer = alignment.farthest(
        np.array([0, 2, 5]), np.array([2, 5, 6]), np.array([0, 3, 5]), np.array([3, 5, 6])
    )
    assert pointer.tolist() == [3, 4, 5, 1, 4, 5]
    assert alignment.labels(pointer).tolist() == [4, 4, 5, 4, 4, 5]


@pytest.mark.parametrize("values", [[], [0], [5, 5, 70_000], [1, 300, 300, 2**24]])
def test_planes(values):
    packed = alignment.planes(np.array(values, dtype=np.int64))
    assert alignment.from_planes(packed).tolist() == values


def test_null_ids_repeats_groups_and_empty_table(spark):
    rows = [(None, "good day"), (None, "good day"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = alignment.align_documents(docs, *FILES, public_tokenizers.PATTERN, keep_groups=True).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["3", "None", "None"]
    texts = {r["groups"] for r in out if r["doc_id"] is None}
    assert len(texts) == 1 and texts.pop().count(";") == 1
    assert [r["count_sum"] for r in out if r["doc_id"] is None] == [4, 4]
    assert alignment.align_documents(docs.limit(0), *FILES, public_tokenizers.PATTERN).count() == 0
