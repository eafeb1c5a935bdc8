"""Keyed tables: merges that touch few buckets, repeated and failed merges, late rows; streams over them."""

import os

import pytest
from pyspark.sql import functions as F

from hazardspark.operators.upsert import upsert
from hazardspark.sinks.keyed import BUCKET, KeyedTable
from hazardspark.streaming import incremental as inc


def files(path):
    """Data files with their sizes and times."""
    found = [os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.startswith("part-")]
    return {f: (os.stat(f).st_size, os.stat(f).st_mtime_ns) for f in found}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, data):
    return spark.createDataFrame(data, "id string, v long, at long")


def test_merge_replaces_only_the_buckets_of_its_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "id", buckets=16)
    assert table.read() is None
    first = frame(spark, [(f"k{i}", i, 1) for i in range(200)])
    table.merge(first)
    before = files(table.path)
    source = frame(spark, [("k7", -7, 2), ("k7", -8, 3), ("new", 5, 2), (None, 1, 1)])
    touched = {r[0] for r in source.where("id IS NOT NULL").select(table.bucket_of(F.col("id"))).collect()}
    table.merge(source, order=["at"])
    after = files(table.path)
    assert all(after[f] == before[f] for f in before)
    new = {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in set(after) - set(before)}
    assert new == touched and len(touched) <= 2
    want = upsert(first, source, "id", order=["at"])
    assert rows(table.read()) == rows(want) and table.read().where("id = 'k7'").first()["v"] == -8
    assert rows(table.read(version=0)) == rows(first)


def test_late_null_and_repeated_rows(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "id", buckets=4)
    table.merge(frame(spark, [("a", 1, 10), ("b", 1, None), ("c", 1, 10)]), order=["at"])
    table.merge(frame(spark, [("a", 2, 9), ("b", 2, 1), ("c", 2, 10), ("c", 3, None), (None, 9, 9)]), order=["at"])
    assert rows(table.read()) == [("a", 1, 10), ("b", 2, 1), ("c", 2, 10)]
    table.merge(frame(spark, [("c", 5, 11), ("d", 6, 1)]), update_cols=["v"], order=["at"])
    assert rows(table.read()) == [("a", 1, 10), ("b", 2, 1), ("c", 5, 11), ("d", 6, 1)]
    assert table.merge(frame(spark, [])) == 3 and table.read().count() == 4


def test_repeated_and_failed_merges(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "id", buckets=4)
    table.merge(frame(spark, [("a", 1, 1), ("b", 1, 1)]), version=0)
    table.merge(frame(spark, [("a", 2, 2)]), order=["at"], version=1)
    once = rows(table.read())
    table.merge(frame(spark, [("a", 2, 2)]), order=["at"], version=1)
    assert rows(table.read()) == once and table.versions() == [0, 1]
    # A merge that ends before its manifest leaves files that nobody reads.
    os.rename(f"{table.path}/manifests/000000001.json", f"{table.path}/manifests/000000001.json.draft")
    assert rows(table.read()) == [("a", 1, 1), ("b", 1, 1)]
    table.merge(frame(spark, [("a", 2, 2)]), order=["at"], version=1)
    assert rows(table.read()) == once


def test_versions_expire_with_their_folders(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "id", buckets=2)
    for i in range(5):
        table.merge(frame(spark, [("a", i, i), ("b" if i == 0 else "a", i, i)]), keep=1)
    assert table.versions() == [3, 4] and rows(table.read()) == [("a", 4, 4), ("b", 0, 0)]
    for v in (3, 4):
        assert table.read(version=v).count() == 2
    kept = {f.split("v=")[1][:9] for f in files(table.path)}
    assert kept <= {"000000000", "000000003", "000000004"}


def test_newest_rows_and_expiry(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    schema = "id string, n long, at timestamp, w double"
    out = []
    for part in (
        [("a", 1, "2025-01-02", 0.5), ("a", 2, "2025-01-03", None), (None, 3, "2025-01-01", 1.0), ("z", 2**62, None, 1.0)],
        [("a", 3, "2025-01-01", 9.0), ("b", 1, "2025-01-01", 1.0), ("z", 2**62 + 1, None, 2.0)],
        [("a", 4, "2025-01-03", 1.0), ("a", 5, "2025-01-03", 2.0), ("b", 0, "2025-01-01", 1.0)],
    ):
        spark.createDataFrame(part, schema.replace("timestamp", "string")).withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(path("src"))
        stream = inc.file_stream(spark, path("src"), spark.read.parquet(path("src")).schema)
        inc.upsert_run(stream, path("table"), "id", ["at", "n"], path("state"), buckets=4)
        inc.upsert_run(stream, path("timed"), "id", ["at", "n"], path("timed-state"), buckets=4, time="at", idle_days=1)
        out.append({r["id"]: r["n"] for r in inc.latest(spark, path("table")).collect()})
    assert out == [{"a": 2, "z": 2**62}, {"a": 2, "b": 1, "z": 2**62 + 1}, {"a": 5, "b": 1, "z": 2**62 + 1}]
    # A row without a time has no place in it; those behind the watermark are dropped, at it they are not older.
    assert {r["id"]: r["n"] for r in inc.latest(spark, path("timed")).collect()} == {"a": 5}


def test_late_rows_over_restarts(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    for part in ([(1, "2025-01-10"), (2, "2025-01-01"), (3, None)], [(4, "2025-01-07"), (5, "2025-01-08"), (6, "2025-02-01")], [(7, "2025-01-29"), (8, "2025-01-30")]):
        spark.createDataFrame(part, "n long, at string").withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(path("src"))
        stream = inc.file_stream(spark, path("src"), spark.read.parquet(path("src")).schema)
        inc.late_rows_run(stream, "at", "2 DAYS", path("kept"), path("late"), path("marks"), path("state"))
    read = lambda name: sorted(r["n"] for r in spark.read.parquet(path(name)).collect())
    assert read("kept") == [1, 2, 5, 6, 8] and read("late") == [3, 4, 7]
    assert [(r["n_kept"], r["n_late"]) for r in spark.read.parquet(path("marks")).orderBy("batch").collect()] == [(2, 1), (2, 1), (1, 1)]


@pytest.mark.parametrize("runs", [1, 3])
def test_either_key_equals_sequential_reading(spark, tmp_path, runs):
    path = lambda name: str(tmp_path / name)
    data = [(i, f"t{i * 7 % 23}", f"http://u/{i * 5 % 31}") for i in range(120)]
    seen, want = set(), []
    for i, t, u in data:
        if t not in seen and u not in seen:
            seen |= {t, u}
            want.append(i)
    step = len(data) // runs
    for k in range(runs):
        part = spark.createDataFrame(data[k * step : (k + 1) * step] + data[:3], "n long, title string, url string").dropDuplicates(["n"])
        part.coalesce(1).write.mode("append").parquet(path("src"))
        stream = inc.file_stream(spark, path("src"), part.schema)
        inc.dedupe_either_run(stream, "title", "url", "n", path("out"), path("seen"), path("state"), buckets=4)
    assert sorted(r["n"] for r in spark.read.parquet(path("out")).collect()) == want
