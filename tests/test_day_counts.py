"""Counts of incremental runs cover every row."""

import datetime as dt

from pyspark.sql import functions as F

from hazardspark.checks.stream_checks import z5
from hazardspark.streaming import incremental as inc

SF = "/root/testdata/sf0.001"


def test_open_days_late_rows_and_rows_without_a_time_are_counted(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    landings = [
        [("a", "2025-01-01 10:00:00"), ("b", "2025-01-02 10:00:00")],
        [("a", "2025-01-03 10:00:00"), ("c", "2025-02-01 00:00:00")],
        [("a", "2025-01-01 09:00:00"), ("a", None)],
    ]
    for rows in landings:
        df = spark.createDataFrame(rows, "id string, ts string").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(path("src"))
        inc.day_counts_run(inc.file_stream(spark, path("src"), df.schema), "ts", "id", path("days"), path("state"))
    days = spark.read.parquet(path("days")).groupBy("day", "id").agg(F.sum("ocorrencias").alias("n"))
    day = lambda m, d: dt.date(2025, m, d)
    assert {(r["day"], r["id"], r["n"]) for r in days.collect()} == {
        (day(1, 1), "a", 2), (day(1, 2), "b", 1), (day(1, 3), "a", 1), (day(2, 1), "c", 1), (None, "a", 1),
    }


def test_z5_counts_every_event(spark):
    assert z5(spark, SF).agg(F.sum("ocorrencias")).first()[0] == spark.read.parquet(f"{SF}/events.parquet").count()
