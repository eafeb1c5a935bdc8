"""Steps whose shuffles and memory must not grow faster than the input: results by hand, and what the plans move."""

import random

from pyspark.sql import functions as F

from hazardspark.operators import dedupe, geo
from hazardspark.operators.upsert import upsert


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_of_deduplicated_rows_shuffles_each_side_once(spark):
    """keep_first keeps its key, so keep-last and the full join find the rows where they are."""
    rows = spark.range(200).select((F.col("id") % 50).cast("string").alias("k"), "id", F.col("id").cast("string").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old = dedupe.keep_first(rows.where("id < 100"), ["k"], ["id"])
        new = dedupe.keep_first(rows.where("id >= 90"), ["k"], ["id"])
        merged = upsert(old, new, "k", ["v"])
        assert _plan(merged).count("Exchange hashpartitioning") == 2
        got = {r["k"]: (r["id"], r["v"]) for r in merged.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {str(k): (k, str(k + 50 if k >= 40 else k + 100)) for k in range(50)}


def test_picked_rows_keep_negative_zero_and_null_keys(spark):
    rows = spark.createDataFrame([(-0.0, None, 1), (0.0, None, 2), (None, "a", 3)], "x double, s string, o int")
    got = {(str(r["x"]), r["s"], r["o"]) for r in dedupe.keep_first(rows, ["x", "s"], ["o"]).collect()}
    assert got == {("-0.0", None, 1), ("None", "a", 3)}
    assert [r["s"] for r in upsert(rows.limit(0), spark.createDataFrame([(1.0, "n", 1), (1.0, None, 5)], rows.schema), "x").collect()] == ["n"]


def test_near_repeats_by_hand_and_few_copies(spark):
    """Chains and dense squares around the tolerance; a candidate goes to at most four blocks, not to every cell and salt."""
    rng = random.Random(4)
    points = [(i, "a" if i % 3 else "b", round(rng.uniform(0, 1e-4), 7), round(rng.uniform(-3e-5, 3e-5), 7)) for i in range(400)]
    kept = []
    for i, k, x, y in points:
        if not any(k == k2 and abs(x - x2) < 1e-5 and abs(y - y2) < 1e-5 for _, k2, x2, y2 in kept):
            kept.append((i, k, x, y))
    df = spark.createDataFrame(points, "o long, k string, lat double, lon double")
    got = dedupe.drop_near_repeats(df, ["k"], "lat", "lon", "o")
    assert {r["o"] for r in got.collect()} == {i for i, *_ in kept}
    cells = spark.createDataFrame([(x, y) for x in range(-20, 20) for y in range(-20, 20)], "_cx long, _cy long")
    assert dedupe._reached_blocks(cells).count() == 2.25 * cells.count()


def test_small_levels_of_many_centroids_are_broadcast(spark):
    """Events are not shuffled to a few names; events with an empty name do not share a key, and find its point."""
    n = 400_000
    centroids = spark.range(n).select(
        F.lit(1.0).alias("latitude"), F.col("id").cast("double").alias("longitude"), F.concat(F.lit("d"), F.col("id") % 3).alias("distrito"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("c"), F.col("id") % 5)).alias("concelho"), F.when(F.col("id") == 7, " ").alias("freguesia"),
        F.format_string("%08d", "id").alias("dicofre"),
        F.lit("x" * 50).alias("pad"),
    )
    given = [(" ", "c1", "d1", None), (None, "C1", "d1", None), ("zz", "zz", "d2 ", None), ("zz", None, "", None), ("", "c1", "d1", 5.0)]
    events = spark.createDataFrame([(i, p, m, d, x, x, "unknown") for i, (p, m, d, x) in enumerate(given)],
        "id long, parish string, municipality string, district string, latitude double, longitude double, georef_class string")
    out = geo.locate(events, centroids)
    assert "SortMergeJoin" not in _plan(out)
    got = {r["id"]: (r["longitude"], r["georef_class"]) for r in out.collect()}
    assert got == {0: (7.0, "freguesia"), 1: (6.0, "concelho"), 2: (2.0, "distrito"), 3: (None, "unknown"), 4: (5.0, "unknown")}
