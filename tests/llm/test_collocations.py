"""Phrase counts and scores against plain counting, the index against a scan, defined cases."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

from gristmill.llm import collocations as c

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text: str | None) -> list[list[str]]:
    parts = re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))
    return [re.findall(r"[^\x20\x09]+", p) for p in parts]


def plain(rows, longest, least, top=2000):
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for words in pieces(text):
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        n = sum(v for g, v in count.items() if len(g) == 1)
        candidates = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        scored = []
        for g, a in candidates.items():
            inside = any(
                len(h) > len(g) and 2 * b >= a and any(h[i : i + len(g)] == g for i in range(len(h)))
                for h, b in candidates.items()
            )
            if not inside:
                cuts = [(1_000_000 * a * a // (count[g[:k]] * count[g[k:]]), k) for k in range(1, len(g))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(g).encode(), a, count[g[:k]], count[g[k:]]))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, n, -score))
    return sorted(out)


def random_rows(seed, n):
    draw = random.Random(seed)
    words = ["a", "B", "c", "dé", "e", "The", "of", "x y", "\x1c"]
    rows = []
    for _ in range(n):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!"]) for _ in range(draw.randint(0, 30)))
        rows.append((draw.choice(["en", "de", None]), text))
    return rows


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "lang string, text string")
    docs = docs.withColumn("phrase", docs.text).withColumn("n", docs.lang).withColumn("_chunk", docs.text)
    return sorted(tuple(r) for r in c.collocations(docs, **options).collect())


@pytest.mark.parametrize(("longest", "seed"), [(2, 1), (3, 2), (4, 3), (5, 4)])
def test_random_texts_as_counted(spark, longest, seed):
    rows = random_rows(seed, 60)
    expected = plain(rows, longest, 3)
    assert expected
    assert run(spark, rows, longest=longest, least=3) == expected


def test_shards_of_one_text_give_the_same(spark):
    rows = random_rows(9, 40)
    assert run(spark, rows, least=4, shard_bytes=1) == plain(rows, 3, 4)


def test_a_least_count_beyond_one_byte(spark):
    rows = [("en", "a b c. " * 400), ("en", "a b")]
    assert run(spark, rows, least=300) == plain(rows, 3, 300)


def test_ranks_stop_at_the_top_and_ties_go_by_bytes(spark):
    rows = [("en", ". ".join(f"{x} {x}z" for x in ["é", "f", "Ｚ", "😀", "a"]))] * 12
    found = run(spark, rows, top=3)
    assert found == plain(rows, 3, 10, top=3)
    assert [r[2] for r in found] == ["a az", "f fz", "é éz"]


def test_defined_cases(spark):
    rows = [(None, None), ("en", ""), ("en", " \n.,"), ("de", "nur drei wörter")]
    assert run(spark, rows) == []
    assert run(spark, [("en", "x y")] * 0 + [("en", None)]) == []
    docs = spark.createDataFrame([], "lang string, text string")
    assert c.collocations(docs).count() == 0
    with pytest.raises(ValueError):
        c.phrase_counts(docs, longest=1)


def test_a_very_long_text(spark):
    rows = [("en", "one two three four " * 30_000)]
    found = run(spark, rows)
    assert found == plain(rows, 3, 10)


def test_intervals_of_both_directions_agree():
    words, s = c.symbols(["a b a b c. a b c a", "b c; c c c"])
    index = c.ShardIndex(s, 3)
    names = words.to_pylist()
    text = " ".join(["."] + [names[x - 1] if x else "." for x in s])
    ahead, back, size = index.words()
    for extend in (index.left, index.right):
        low, twin, count, _ = extend(ahead, back, size)
        for i in range(len(low)):
            phrase = [int(x[0]) for x in index.spell(low[i : i + 1], 2)]
            want = sum(s[j] == phrase[0] and s[j + 1] == phrase[1] for j in range(len(s) - 1))
            assert count[i] == want, text
            # The twin interval holds the reversed phrase.
            place = index.back.order[twin[i]]
            reverse = s[::-1]
            assert [int(reverse[place]), int(reverse[(place + 1) % len(s)])] == phrase[::-1]


def test_exact_scores_beyond_64_bits(spark):
    # 10^9 occurrences cannot be written down here: the arithmetic is checked on the rows.
    from pyspark.sql import functions as F

    a, left, right = 10**13, 10**13 + 7, 10**13 + 9
    row = spark.range(1).select(*(F.lit(v).cast("bigint").alias(n) for n, v in (("a", a), ("l", left), ("r", right))))
    assert row.select(F.expr(c.SCORE)).first()[0] == 1_000_000 * a * a // (left * right)
    assert np.int64(a) == a
