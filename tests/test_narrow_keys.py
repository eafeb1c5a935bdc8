"""Keep-one rows travel once; the exact title-or-url rounds keep whole rows out of what they write."""

import itertools
import random

from pyspark.sql import functions as F

from hazardspark.operators import dedupe
from hazardspark.sinks import files


def test_order_travels_once(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", None, "z"), (None, None, "n")], "k string, o int, v string")
    first = dedupe.keep_first(df, ["k"], ["o"])
    assert sorted(map(tuple, first.collect()), key=str) == sorted([("a", 1, "y"), (None, None, "n")], key=str)
    assert sorted(map(tuple, dedupe.keep_last(df, ["k"], ["o"]).collect()), key=str) == sorted([("a", 2, "x"), (None, None, "n")], key=str)
    assert "min_by" not in first._jdf.queryExecution().optimizedPlan().toString()
    held = df.withColumn("m", F.create_map(F.lit("k"), F.col("v")))
    assert sorted(r["v"] for r in dedupe.keep_first(held, ["k"], ["o"]).collect()) == ["n", "y"]


def test_title_or_url_equals_reading_and_ends_without_an_order(spark):
    rng = random.Random(5)
    rows = [(i, f"t{rng.randrange(9)}", f"u{rng.randrange(9)}?{i}") for i in range(60)]
    titles, urls, want = set(), set(), []
    for i, t, u in rows:
        if t not in titles and u.split("?")[0] not in urls:
            titles.add(t), urls.add(u.split("?")[0]), want.append(i)
    df = spark.createDataFrame([*rows, (None, "no order", "anywhere")], "o int, t string, u string")
    assert sorted(r["o"] for r in dedupe.keep_first_title_or_url(df, "t", "u", "o").collect()) == want


def test_compressed_csv_reads_the_same(spark, tmp_path):
    df = spark.createDataFrame([("a\n\"b", ""), ("c, d", None)], "x string, y string").coalesce(1)
    files.write_csv(df, str(tmp_path / "plain"))
    files.write_csv(df, str(tmp_path / "gz"), compression="gzip")
    read = lambda n: spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / n)).collect()
    assert read("plain") == read("gz") and len(read("gz")) == 2
    assert list(itertools.chain((tmp_path / "gz").glob("*.csv.gz")))
