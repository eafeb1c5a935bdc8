"""Keywords are looked for once, and only in rows that need a score."""

from pyspark.sql import functions as F

from hazardspark.checks.base import QUERIES
from hazardspark.functions import extract as X


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_score_and_categories_share_the_search(spark):
    df = spark.createDataFrame([("HTTP://a/Morto", "ferido no hospital"), (None, None)], "u string, t string")
    out = df.select(X.relevance(F.col("u"), F.col("t")).alias("r"))
    assert _plan(out).count("faleceu") == 1
    got = [(r["r"]["score"], r["r"]["categories"]) for r in out.collect()]
    assert got == [(3 + 2 + 2, ["victims", "injuries"]), (0, [])]


def test_least_relevance_builds_no_categories(spark):
    plan = QUERIES["f11_min_relevance"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_compact" not in plan and "displacement" not in plan


def test_counts_score_only_rows_that_reach_the_score(spark, monkeypatch):
    from hazardspark.operators import filters

    seen = []
    monkeypatch.setattr(filters.X, "relevance_score", lambda text: seen.append(str(text)) or F.raise_error(F.lit("scored")).cast("int"))
    df = spark.createDataFrame([("x", "http://y", "t", "d", "p", "1/1/2001")], "ID string, page string, title string, district string, parish string, date string")
    none = spark.createDataFrame([], "name string")
    counts = filters.cascade_counts(df, none, none, "2001-08-01", ["ID"])
    assert seen and [r["n_rows"] for r in counts.orderBy("stage_no").collect()][:2] == [1, 0]
