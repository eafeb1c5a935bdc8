"""Places in text: a few names are looked for in the row, and the gazetteer's true size decides."""

import pytest
from pyspark.sql import functions as F

from hazardspark.operators import geo


def _docs(spark):
    rows = [("a", "Cheia em São João e em Faro"), ("a", "Cheia em São João e em Faro"), (None, "FARO"), ("b", None), ("c", "nada")]
    return spark.createDataFrame(rows, "id string, text string")


def _places(spark):
    return spark.createDataFrame([("Faro", 2), ("São João", 3), ("João", 5), ("...", 1), ("nada", None), ("", 0)], "name string, rank int")


@pytest.mark.parametrize("few", [0, 128])
def test_same_rows_with_and_without_grams(spark, monkeypatch, few):
    monkeypatch.setattr(geo, "FEW_NAMES", few)
    args = (_docs(spark), "id", "text", _places(spark), "name", "rank")
    got = sorted((r["id"] or "", r["place"]) for r in geo.places_in_text(*args).collect())
    assert got == [("", "Faro"), ("a", "Faro"), ("a", "João"), ("a", "São João"), ("c", "nada")]
    first = sorted((r["id"] or "", r["place"] or "") for r in geo.first_place_in_text(*args).collect())
    assert first == [("", "Faro"), ("a", "Faro"), ("a", "Faro"), ("b", ""), ("c", "")]


def test_first_of_few_places_shuffles_no_text(spark):
    docs = _docs(spark)
    plan = geo.first_place_in_text(docs, "id", "text", _places(spark), "name", "rank")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_names_drawn_from_a_large_table_are_small(spark, monkeypatch):
    """Five names out of many rows: the texts are not shuffled by their grams."""
    monkeypatch.setattr(geo, "FEW_NAMES", 0)
    monkeypatch.setattr(geo, "SMALL_GAZETTEER_BYTES", 100_000)
    names = spark.range(200_000).select(F.concat(F.lit("place"), (F.col("id") % 5).cast("string")).alias("name")).distinct()
    docs = spark.createDataFrame([(1, "in place3 and place9")], "id int, text string")
    found = geo.places_in_text(docs, "id", "text", names.withColumn("rank", F.col("name")), "name", "rank")
    assert [r["place"] for r in found.collect()] == ["place3"]
    assert "_of" not in found._jdf.queryExecution().optimizedPlan().toString()
