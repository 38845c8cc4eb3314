"""Change logs and the reorder buffer: batches in any cut, replays, hot keys, gaps, late rows."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from gristmill.operators import order
from gristmill.sources.readers import text_stream
from gristmill.streaming import changelog, detector, reorder, runs

LIMIT = 180


def put(folder, name: str, lines, at: int) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    os.utime(folder / name, (1_600_000_000 + at * 60,) * 2)  # files arrive in order


def records(lines):
    part = F.split("value", ",")
    return lines.select(
        F.nullif(part[0], F.lit("-")).alias("k"),
        F.nullif(part[1], F.lit("-")).cast("long").alias("seq"),
        part[2].try_cast("timestamp_ntz").alias("ts"),
    )


def stream_of(spark, folder):
    return records(text_stream(spark, path=str(folder), files_per_trigger=1))


def forget_last_commit(checkpoint) -> int:
    """As after a driver that was lost between a batch's work and its commit."""
    commits = sorted((p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    commits[-1].unlink()
    (checkpoint / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    return int(commits[-1].name)


def test_running_counts_split_a_hot_key(spark):
    draw = random.Random(1)
    data = [(draw.choice(["hot"] * 9 + ["x", None]), i) for i in range(200)]
    rows = spark.createDataFrame(data, "k string, seq long").repartition(5)
    carried = spark.createDataFrame([("hot", 1000), ("gone", 7)], "k string, _total long")
    changes, total = changelog.running_counts(rows, ["k"], ["seq"], carried, block_rows=9)
    seen = {"hot": 1000, "gone": 7}
    expected = []
    for k, i in data:
        seen[k] = seen.get(k, 0) + 1
        expected.append((k, i, seen[k]))
    assert sorted(map(tuple, changes.collect()), key=lambda r: r[1]) == expected
    assert dict(map(tuple, total.collect())) == seen


def test_running_counts_over_blocks_of_a_sample_need_no_join(spark):
    draw = random.Random(3)
    data = [(draw.choice(["hot"] * 9 + ["x", None]), draw.choice([None, *range(3000)]), draw.choice("ab") * draw.randint(0, 2)) for _ in range(20_000)]
    rows = spark.createDataFrame(data, "k string, seq long, sub string").repartition(7)
    carried = spark.createDataFrame([("hot", 1000), (None, 5)], "k string, _total long")
    changes, total = changelog.running_counts(rows, ["k"], ["seq", "sub"], carried, block_rows=500)
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "rangepartitioning" not in plan
    seen = {"hot": 1000, None: 5}
    expected = []
    for k, seq, sub in sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[2], str(r[0]))):
        seen[k] = seen.get(k, 0) + 1
        expected.append((str(k), seq or -1, sub, seen[k]))
    assert sorted((str(k), -1 if seq is None else seq or -1, sub, n) for k, seq, sub, n in changes.collect()) == sorted(expected)
    assert dict(map(tuple, total.collect())) == seen
    sizes = {r["_block"]: r["count"] for r in changelog.with_block(rows, ["seq", "sub"], 500).groupBy("_block").count().collect()}
    assert 30 < len(sizes) <= 45 and max(sizes.values()) < 1500


def test_blocks_follow_the_order_and_hold_equal_rows(spark):
    rows = spark.createDataFrame([(i % 50 or None,) for i in range(1000)], "seq long")
    placed = changelog.with_block(rows, ["seq"], 10).distinct().collect()
    blocks = [r["_block"] for r in sorted(placed, key=lambda r: r["seq"] or 0)]
    assert len(blocks) == 50 and blocks == sorted(blocks)
    assert changelog.with_block(rows.limit(0), ["seq"], 10).collect() == []


def test_a_change_log_over_batches_restarts_and_a_replay(spark, tmp_path):
    draw = random.Random(2)
    data = [(draw.choice("aaab-"), i) for i in range(40)]
    lines = [f"{k},{i},2020-01-01" for k, i in data]
    args = ["k"], ["seq"], str(tmp_path / "o"), str(tmp_path / "s"), str(tmp_path / "c")
    for i in range(4):
        put(tmp_path / "in", f"f{i}", lines[i * 10 : i * 10 + 10], i)
        runs.finish(changelog.by_batches(stream_of(spark, tmp_path / "in"), *args, block_rows=3), LIMIT)
    assert forget_last_commit(tmp_path / "c") == 3
    runs.finish(changelog.by_batches(stream_of(spark, tmp_path / "in"), *args, block_rows=3), LIMIT)
    got = spark.read.parquet(str(tmp_path / "o")).select("k", "seq", "n")
    seen, expected = {}, []
    for k, i in data:
        seen[k] = seen.get(k, 0) + 1
        expected.append((None if k == "-" else k, i, seen[k]))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == ["slot=0", "slot=1"]


def pieces(spark, *batches):
    return [spark.createDataFrame([(n,) for n in batch], "seq long") for batch in batches]


def passed(spark, path, delay, batches, dense=False):
    out = []
    for i, batch in enumerate(pieces(spark, *batches)):
        rows = reorder.release(spark, batch, i, "seq", delay, str(path), dense).collect()
        out.append(sorted(((r["seq"], r["late"]) for r in rows), key=str))
    return out


def test_rows_wait_for_the_watermark(spark, tmp_path):
    got = passed(spark, tmp_path, 3, [[1, 5, 2], [4, 3, 9], [6, 1], []])
    assert got == [
        [(1, False), (2, False)],  # 5 - 3 = 2
        [(3, False), (4, False), (5, False)],  # 9 - 3 = 6, which is not there yet
        [(1, True), (6, True)],  # 6 was waited for long enough
        [],
    ]


def test_dense_numbers_go_on_up_to_the_first_gap(spark, tmp_path):
    got = passed(spark, tmp_path, 100, [[2, 1, 4], [3, 3, 6], [5, 9], [4]], dense=True)
    assert got == [
        [(1, False), (2, False)],
        [(3, False), (3, False), (4, False)],
        [(5, False), (6, False)],
        [(4, True)],
    ]


def test_rows_without_a_number_and_the_flush(spark, tmp_path):
    assert passed(spark, tmp_path, 10, [[None, 5], [None]]) == [[(None, False)], [(None, True)]]
    rest = []
    schema = pieces(spark, [])[0].schema
    reorder.flush(spark, schema, "seq", lambda rows, n: rest.append((n, [r["seq"] for r in rows.collect()])), str(tmp_path), 2)
    assert rest == [(2, [5])]


def test_an_empty_input_passes_nothing(spark, tmp_path):
    assert passed(spark, tmp_path, 5, [[], []], dense=True) == [[], []]


@pytest.mark.parametrize(("seed", "keys"), [(1, ["k"]), (2, [])])
def test_late_rows_across_batches_as_the_batch_form(spark, tmp_path, seed, keys):
    """Rows up to 20 numbers late in four batches; the last batch is replayed."""
    draw = random.Random(seed)
    lines = [f"{i * 7 % 5},{i},2020-01-{draw.randint(1, 28):02d}" for i in range(120)]
    comes = sorted(range(120), key=lambda i: i + draw.randint(0, 20))
    o, s, c = (str(tmp_path / x) for x in "osc")
    held = []
    for i in range(4):
        put(tmp_path / "in", f"f{i}", [lines[j] for j in comes[i * 30 : i * 30 + 30]], i)
        stream = stream_of(spark, tmp_path / "in")
        args = dict(delay=21, path=o, carry=s, checkpoint=c, keys=keys, bucket_rows=7)
        runs.finish(detector.by_reordered_batches(stream, "seq", "ts", **args), LIMIT)
        held.append(spark.read.parquet(f"{s}/held/rows/slot={i % 2}").count())
    assert max(held) <= 21 and min(held) > 0
    assert forget_last_commit(tmp_path / "c") == 3
    runs.finish(detector.by_reordered_batches(stream, "seq", "ts", **args), LIMIT)
    detector.flush_reordered(spark, stream.schema, "seq", "ts", o, s, 4, keys, bucket_rows=7)
    got = runs.read_batches(spark, o, stream.schema.add("prev_ts", "timestamp_ntz")).drop("batch_id")
    batch = records(spark.read.text(str(tmp_path / "in")))
    expected = order.out_of_order(batch, "ts", "seq", keys)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
