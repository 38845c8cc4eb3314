"""Rolled files: names, sizes, ages, failed tasks, retries, replays, and every row back."""

from __future__ import annotations

import os
import random

import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from gristmill.sources import rolled
from gristmill.sources.readers import text_stream
from gristmill.streaming import runs

SCHEMA = "id bigint, name string, amount double, day date"
NAMES = ["plain", "a,b", 'say "x"', "two\nlines", "", None, " edge ", "čas 😀"]


@pytest.fixture(autouse=True)
def registered(spark):
    rolled.register(spark)


def table(spark, n=400):
    draw = random.Random(3)
    data = [(i, draw.choice(NAMES), i / 4 if i % 7 else None) for i in range(n)]
    return spark.createDataFrame(data, "id bigint, name string, amount double").withColumn(
        "day", F.date_add(F.lit("2022-01-01").cast("date"), F.col("id").cast("int"))
    )


def shown(path):
    return sorted(f for f in os.listdir(path) if not f.startswith("_"))


def test_all_rows_come_back_in_small_files(spark, tmp_path):
    df, path = table(spark).repartition(3), str(tmp_path / "o")
    writer = df.write.format("rolled").mode("append").options(
        kind="csv", prefix="counts", suffix=".ext", max_bytes=1000, path=path
    )
    writer.save()
    names = shown(path)
    assert len(names) > 10 and all(n.startswith("counts-") and n.endswith(".ext") for n in names)
    assert max(os.path.getsize(f"{path}/{n}") for n in names) <= 1000
    got = rolled.read_rolled(spark, path, SCHEMA)
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    # Another append adds a write; overwriting takes the place of both.
    writer.save()
    assert rolled.read_rolled(spark, path, SCHEMA).count() == 2 * df.count()
    df.limit(5).write.format("rolled").mode("overwrite").options(kind="csv", path=path).save()
    assert rolled.read_rolled(spark, path, SCHEMA).count() == 5
    assert all(n.startswith("part-") for n in shown(path))


def test_a_header_counts_and_is_read(spark, tmp_path):
    path = str(tmp_path / "o")
    df = table(spark, 50).coalesce(1)
    df.write.format("rolled").mode("append").options(kind="csv", header=True, sep="|", max_bytes=200, path=path).save()
    got = rolled.read_rolled(spark, path, SCHEMA, header=True, sep="|")
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    assert len(shown(path)) > 3


def test_text_lines(spark, tmp_path):
    path = f"file:{tmp_path}/o"
    df = spark.createDataFrame([("one",), ("two\r\nparts",), (None,), ("x" * 50,)], "value string").coalesce(1)
    df.write.format("rolled").mode("append").options(max_bytes=10, path=path).save()
    assert sorted(r[0] for r in rolled.read_rolled(spark, path, "value string", "text").collect()) == [
        "", "one", "two parts", "x" * 50
    ]
    # A line longer than a file has one of its own.
    assert sorted(os.path.getsize(tmp_path / "o" / n) for n in shown(tmp_path / "o"))[-1] == 51


def test_a_file_that_is_open_too_long_ends():
    now = [0.0]
    options = rolled.Options("/tmp", max_seconds=60)
    roller = rolled.Roller(options, ["v"], clock=lambda: now[0])
    try:
        for at in (0, 30, 59, 60, 61, 130):
            now[0] = float(at)
            roller.add(pa.array([f"{at}\n"], pa.large_string()))
        roller.close()
        assert [rows for _, rows, _ in roller.staged] == [3, 2, 1]
    finally:
        rolled.drop(options, [rolled.Written(0, roller.staged)])


def test_a_failed_write_shows_nothing(spark, tmp_path):
    path = str(tmp_path / "o")

    def fail(batches):
        for batch in batches:
            yield batch
        if TaskContext.get().partitionId() == 1:
            raise RuntimeError("lost")

    df = spark.range(0, 100, 1, 2).selectExpr("cast(id as string) as value")
    broken = df.mapInArrow(fail, df.schema)
    with pytest.raises(Exception, match="lost"):
        broken.write.format("rolled").mode("append").options(path=path).save()
    assert not os.path.exists(path) or shown(path) == []
    assert rolled.read_rolled(spark, path, "value string", "text").count() == 0
    df.write.format("rolled").mode("append").options(path=path).save()
    assert rolled.read_rolled(spark, path, "value string", "text").count() == 100


def test_a_file_without_a_manifest_is_not_read(spark, tmp_path):
    path = str(tmp_path / "o")
    spark.range(3).selectExpr("cast(id as string) as value").write.format("rolled").mode("append").options(path=path).save()
    (tmp_path / "o" / "part-half-00000-00000").write_text("half\n")
    assert rolled.read_rolled(spark, path, "value string", "text").count() == 3


def test_a_replayed_batch_takes_the_place_of_its_first_run(spark, tmp_path):
    folder, path, check = tmp_path / "in", str(tmp_path / "o"), tmp_path / "c"
    folder.mkdir()
    for i in range(3):
        (folder / f"f{i}").write_text("".join(f"{i}-{j}\n" for j in range(20)))
        os.utime(folder / f"f{i}", (1_600_000_000 + i * 60,) * 2)

    def run():
        stream = text_stream(spark, path=str(folder), files_per_trigger=1).select("value")
        runs.finish(runs.to_rolled(stream, path, str(check), every=None, kind="text", max_bytes=40), 120)

    run()
    before = shown(path)
    (check / "commits" / "2").unlink()
    (check / "commits" / ".2.crc").unlink(missing_ok=True)
    run()
    assert shown(path) == before
    got = sorted(r[0] for r in rolled.read_rolled(spark, path, "value string", "text").collect())
    assert got == sorted(f"{i}-{j}" for i in range(3) for j in range(20))


def test_wrong_options_are_told(spark, tmp_path):
    df = spark.range(1)
    for options in ({"path": str(tmp_path / "a")}, {"path": str(tmp_path / "a"), "kind": "xml"}):
        with pytest.raises(Exception, match="one column of strings|no kind of file"):
            df.write.format("rolled").mode("append").options(**options).save()
