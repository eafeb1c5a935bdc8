"""Scores of the relevance model are values to later filters."""

import re

from pyspark.sql import functions as F

from hazardspark.checks import ml_checks
from hazardspark.operators import relevance

SF = "/root/testdata/sf0.001"


def test_a_filter_on_the_score_holds_none_of_the_models_functions(spark):
    df = ml_checks.m3(spark, SF)
    filters = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if re.match(r"[\s:+\-]*Filter", line)]
    assert filters and not any("UDF" in line for line in filters)
    rows = ml_checks.relevance_rows(spark, SF)
    scored = relevance.score(rows, ml_checks.relevance_model(spark, SF)).select("doc_id", "ml_relevance_score", "source").collect()
    by_rule = {r["doc_id"] for r in rows.where(relevance.model_or_rules(F.lit(0.0), F.col("source"))).select("doc_id").collect()}
    want = {r["doc_id"] for r in scored if r["ml_relevance_score"] >= 0.6} | by_rule
    assert {r["doc_id"] for r in df.collect()} == want
