"""Textual dates, and cascade rows and counts from one pass."""

import pytest
from pyspark.sql import functions as F

from hazardspark.functions import dates as D
from hazardspark.operators import dedupe


@pytest.mark.parametrize(
    ("text", "date"),
    [
        ("12 de janeiro de 2025", "2025-01-12"), (" 1 de MARÇO  de 2024 ", "2024-03-01"), ("1 de marco de 2024", "2024-03-01"), ("3 févr. 2024", "2024-02-03"),
        ("Sep 3, 2024", "2024-09-03"), ("30 fevereiro 2024", None), ("12 foo 2025", None), ("12 jui 2025", None), ("12 de janeiro", None), ("", None), (None, None),
        ("x 12 de janeiro de 2025", None), ("12/01/2025", None),
    ],
)
def test_textual_dates(one, text, date):
    got = one(lambda c: D.parse_text_date(c, ["{d} de {M} de {y}", "{d} {M} {y}", "{M} {d}, {y}"]), text)
    assert str(got) == str(date)


def test_formats_and_months_of_the_caller(one):
    assert str(one(lambda c: D.parse_text_date(c, ["{y}: {m}-{d}"]), "2025: 4-07")) == "2025-04-07"
    assert str(one(lambda c: D.parse_text_date(c, ["{d} {M} {y}"], {"Jänner": 1, "Februar": 2}), "5 jan 2020")) == "2020-01-05"
    with pytest.raises(ValueError):
        D.parse_text_date(F.lit("x"), ["{d} {y}"])


def test_counts_come_with_the_rows(spark):
    from hazardspark.checks import filter_checks as fc
    from hazardspark.operators import filters

    a, d, p = fc._cascade_args(spark, "/root/testdata/sf0.001")
    rows, counts = filters.observed_cascade(a, d, p, fc.AS_OF, ["seq"], fc.MAX_AGE)
    want = filters.cascade(a, d, p, fc.AS_OF, ["seq"], fc.MAX_AGE)
    got = sorted(r["seq"] for r in rows.collect())
    assert got == sorted(r["seq"] for r in want.select("seq").collect()) and got
    table = counts().orderBy("stage_no").collect()
    numbers = [r["n_rows"] for r in table]
    assert numbers == sorted(numbers, reverse=True) and numbers[0] == a.count() and numbers[-1] == len(got)
    # One scan of the articles for rows and counts together.
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("lineitem.parquet") == 1 and plan.count("CollectMetrics") == 3


def test_content_keys_are_those_there(spark):
    assert dedupe.content_keys(spark.range(1).selectExpr("1 AS date", "2 AS x", "3 AS district")) == ["district", "date"]
