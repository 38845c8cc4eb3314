from __future__ import annotations

import hashlib
import random
from collections import Counter

from gristmill.llm import sharding


def test_shards_fit_and_only_oversized_buckets_split(spark):
    draw = random.Random(1)
    rows = [(i, "é" * draw.randint(0, 60)) for i in range(500)]
    rows += [(1000, "z" * 5000), (None, "abc"), (None, None), (7, None)] + [(3000, "r" * 40)] * 60
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, shard string, hash string")
    out = sharding.assign_shards(docs, 800).collect()
    assert len(out) == len(rows)
    total = Counter()
    for r in out:
        total[r.shard, r.page] += r.n_bytes
        assert len(r.shard) == r.depth
    assert all(n <= 800 for (s, p), n in total.items() if n != 5000)
    assert sum(n == 5000 for n in total.values()) == 1
    assert len({r.page for r in out if r.doc_id == 3000}) == 3

    def bits(key, text):
        null = "null"
        body = f"{null if key is None else key}:{null if text is None else hashlib.md5(text.encode()).hexdigest()}"
        return bin(int(hashlib.md5(body.encode()).hexdigest()[:15], 16))[2:].zfill(60)

    hashes = [(bits(k, t), len((t or "").encode())) for k, t in rows]
    for shard in {r.shard for r in out if r.depth}:
        parent = [n for h, n in hashes if h.startswith(shard[:-1])]
        assert sum(parent) > 800 and len({h for h, _ in hashes if h.startswith(shard[:-1])}) > 1


def test_empty_and_single(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.assign_shards(docs, 10).count() == 0
    one = spark.createDataFrame([(1, "abc", "a"), (2, "de", "b")], "doc_id long, text string, extra string")
    assert {(r.shard, r.depth) for r in sharding.assign_shards(one, 10).collect()} == {("", 0)}
    sharding.write_shards(one, 3, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").select("doc_id", "text", "extra").count() == 2


def test_written_rows_are_the_rows_given(spark, tmp_path):
    rows = [(None, f"n{i:03}" * 8) for i in range(60)] + [(7, f"r{i:03}" * 8) for i in range(20)]
    rows += [(9, "z" * 30)] * 50 + [(i, "é" * 9) for i in range(100, 130)] + [(None, None), (None, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, hash string")
    sharding.write_shards(docs, 300, f"{tmp_path}/out")
    out = spark.read.parquet(f"{tmp_path}/out").collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter(rows)
    total = Counter()
    for r in out:
        total[r.shard, r.page] += len((r.text or "").encode())
    assert max(total.values()) <= 300
    assert len({r.page for r in out if r.doc_id == 9}) == 5
