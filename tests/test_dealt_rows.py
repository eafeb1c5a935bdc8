"""Whole rows of a publication are shuffled once; only keys and names travel to a level too large to broadcast."""

import random

import pytest
from pyspark.sql import functions as F

from hazardspark.operators import dedupe, geo
from hazardspark.operators.upsert import upsert
from hazardspark.plans import publication
from hazardspark.schemas import EVENT, VICTIMS


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rows_dealt_by_the_key_are_those_of_the_full_join(spark):
    rng = random.Random(3)
    value = lambda: rng.choice([None, 1, 2, 3])
    kinds = "id string, n int, s string, updated_at timestamp"
    target = spark.createDataFrame([(k, value(), f"t{i}", None) for i, k in enumerate(["a", "a", "b", "c", None, None, "d"])], kinds)
    source = spark.createDataFrame([(rng.choice(["a", "b", "c", "e", "f", None]), value(), f"s{i}", None) for i in range(12)], kinds)
    stamp = F.lit("2025-01-01 00:00:00").cast("timestamp")
    for names in (None, ["n"]):
        want = _sorted(upsert(target, source, "id", names, updated_at=stamp))
        assert _sorted(upsert(target, source, "id", names, updated_at=stamp, dealt=True)) == want and len(want) > 7
    assert _sorted(upsert(target.limit(0), source, "id", dealt=True)) == _sorted(upsert(target.limit(0), source, "id"))
    assert _sorted(upsert(target, source.limit(0), "id", dealt=True)) == _sorted(target)


def _centroids(spark):
    rows = [(1.0, 2.0, "d1", "c1", "p1", "1"), (3.0, 4.0, "d1", "c1", "", "2"), (5.0, 6.0, "d1", "c2", None, "3"), (7.0, 8.0, "d2", None, None, "4"),
            (9.0, 9.0, "d1", "c1", " P1 ", "0"), (None, 1.0, "d1", "c1", "p2", "5")]
    return spark.createDataFrame(rows, "latitude double, longitude double, distrito string, concelho string, freguesia string, dicofre string")


def test_points_by_key_are_those_of_the_join(spark, no_broadcast):
    given = [(p, m, d, x, y) for p in ("p1 ", "P2", "", " ", None, "zz") for m in ("c1", "C2", None, "") for d in ("d1", "d2", None) for x, y in ((None, None), (0.5, None), (0.5, 0.5))]
    # A repeated key has a point for each of its names.
    rows = [(f"k{i // 2}", *r, "unknown") for i, r in enumerate(given)]
    events = spark.createDataFrame(rows, "id string, parish string, municipality string, district string, latitude double, longitude double, georef_class string")
    want = _sorted(geo.locate(events, _centroids(spark)))
    assert _sorted(geo.locate(events, _centroids(spark), "id")) == want
    assert len(want) == len(rows) and {r[-1] for r in want} == {"freguesia", "concelho", "distrito", "unknown"}


def test_whole_rows_are_shuffled_once_up_to_the_main_table(spark, no_broadcast):
    text = ["type", "subtype", "hour", "georef", "district", "municipali", "parish", "DICOFREG", "source", "sourcedate", "sourcetype", "page"]
    rows = spark.range(60).select(
        "id", F.concat(F.lit("x"), F.col("id") % 40).alias("ID_"), F.lit("05/06/2025").alias("date"), *[F.lit("d1" if c == "district" else "p1" if c == "parish" else "v").alias(c) for c in text],
        *[(F.col("id") % 5).cast("int").alias(v) for v in VICTIMS],
    )
    staging = dedupe.keep_first(rows, ["ID_"], ["id"]).drop("id").withColumnRenamed("ID_", "ID")
    stamp = F.lit("2025-01-01 00:00:00").cast("timestamp")
    events = publication.events_of_staging(staging.where(F.col("fatalities") > 3), stamp).withColumn("type", F.lit("w"))
    out = publication.publish(staging, events, spark.createDataFrame([], EVENT), _centroids(spark), stamp)
    got = out.main.collect()
    assert len(got) == 40 and {(r["latitude"], r["georef_class"]) for r in got} == {(9.0, "freguesia")}
    assert {r["type"] for r in got} == {"v"} and sorted(map(str, got)) == sorted(map(str, out.events.collect()))
    plan = out.main._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Staging goes to its ids once; located events go nowhere (the empty main table leaves the plan).
    written = [line.split("Exchange hashpartitioning(")[1][:3] for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "Reused" not in line]
    assert written.count("ID_") == 1 and "id#" not in written, written
