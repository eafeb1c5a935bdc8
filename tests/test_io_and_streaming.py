"""Sources and sinks on small files, streams against the batch operators."""

import json

import pytest
from pyspark.sql import functions as F

from hazardspark.operators.dedupe import keep_last
from hazardspark.sinks import files
from hazardspark.sources import catalogues, gazetteer, lake, tables
from hazardspark.streaming import incremental as inc


def test_feature_pages_until_empty(spark, tmp_path):
    for i in range(3):
        rows = [{"attributes": {"Natureza": "Cheia" if j else "Vento", "Concelho": f"C{i}{j}", "Latitude": 1.5}} for j in range(2)] if i < 2 else []
        (tmp_path / f"page{i}.json").write_text(json.dumps({"features": rows}, indent=1))
    got = catalogues.feature_pages(spark, str(tmp_path))
    assert sorted(r["Concelho"] for r in got.collect()) == ["C01", "C11"]
    assert catalogues.feature_pages(spark, str(tmp_path), kind=None).count() == 4


def test_rss_files(spark, tmp_path):
    item = "<item><title>{}</title><link>http://x.pt/{}?a=1</link><pubDate>{}</pubDate></item>"
    body = item.format("Cheia &amp; vento", 1, "Fri, 24 Jan 2025 07:00:00 GMT") + item.format("", 2, "x") + item.format("sem data", 3, "")
    (tmp_path / "feed.xml").write_text(f"<rss><channel>{body}</channel></rss>")
    got = catalogues.rss_files(spark, str(tmp_path), "cheias", "Lisboa", "2025-01-24").collect()
    assert [(r["title"], r["link"], r["keyword"]) for r in got] == [("Cheia & vento", "http://x.pt/1?a=1", "cheias")]


def test_nested_gazetteer_file(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps({"P": {"D1": ["a", "b"], "D2": []}}))
    from hazardspark.schemas import GAZETTEER_BY_PROVINCE

    nested = gazetteer.read_nested(spark, str(tmp_path / "g.json"), GAZETTEER_BY_PROVINCE)
    got = sorted((r["district"], r["place"]) for r in gazetteer.places_by_province(nested).collect())
    assert got == [("D1", "D1"), ("D1", "a"), ("D1", "b"), ("D2", "D2")]
    assert gazetteer.flat_localities(nested).count() == 4


def test_labelled_spans_file(spark, tmp_path):
    data = [{"text": "Morreram 57 pessoas", "entities": [{"start": 9, "end": 11, "label": "FATALITIES"}]}]
    (tmp_path / "spans.json").write_text(json.dumps(data, indent=1))
    got = gazetteer.labelled_spans(spark, str(tmp_path / "spans.json")).collect()
    assert [(r["span"], r["label"]) for r in got] == [("57", "FATALITIES")]


def test_extractor_quality_on_spans(spark):
    from hazardspark.operators.report import span_quality

    spans = spark.createDataFrame([("12 mortos na cheia", 0, 2, "FATALITIES", "12"), ("cheia faz 4 vítimas", 10, 11, "INJURED", "4")], "text string, start int, end int, label string, span string")
    got = {r["label"]: (r["n_true"], r["n_right"], r["recall"]) for r in span_quality(spans).collect()}
    assert got["FATALITIES"] == (1, 1, 1.0) and got["INJURED"] == (1, 0, 0.0)


def test_first_existing_of_ranked_paths(spark, tmp_path):
    paths = lake.dated_candidates(str(tmp_path), "2025-06-14", "artigos")
    assert len(paths) == len(set(paths)) and paths[0].endswith("structured/2025/06/14/artigos_2025-06-14.csv")
    assert lake.first_existing(spark, paths, lambda p: p) is None
    target = tmp_path / "raw" / "artigos.csv"
    target.parent.mkdir()
    target.write_text("x\n1\n")
    assert lake.first_existing(spark, paths, lambda p: p) == str(target)


def test_centroid_layer_needs_coordinates(spark):
    with pytest.raises(ValueError):
        gazetteer.centroid_layer(spark.range(1), "concelho")
    with pytest.raises(ValueError):
        gazetteer.parish_codes(spark.range(1), "Freguesia", "Código", ["id"])


def test_dated_lake_is_pruned(spark, tmp_path):
    df = spark.createDataFrame([(1, "2025-06-14"), (2, "2025-06-15")], "i int, d string").withColumn("d", F.to_date("d"))
    files.write_dated(df, str(tmp_path / "lake"), F.col("d"))
    day = lake.on_day(spark.read.parquet(str(tmp_path / "lake")), "2025-06-15")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert [r["i"] for r in day.collect()] == [2]


def test_query_table_prunes_columns(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = tables.query_table(orders, "o_orderkey, o_totalprice").where("o_totalprice > 10")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan and "GreaterThan(o_totalprice,10.0)" in plan


def _files(spark, path, parts):
    for i, rows in enumerate(parts):
        df = spark.createDataFrame(rows, "id string, n int, ts string").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(path)


PARTS = [
    [("a", 1, "2025-01-01 10:00:00"), ("b", 1, "2025-01-02 10:00:00")],
    [("a", 2, "2025-01-03 10:00:00"), ("a", 3, "2025-01-03 11:00:00"), ("c", 1, "2025-02-01 00:00:00")],
    [("a", 9, "2025-01-01 09:00:00")],
]


def test_streams_equal_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    path = lambda name: str(tmp_path / name)
    for i, part in enumerate(PARTS):
        _files(spark, src, [part])
        schema = spark.read.parquet(src).schema
        stream = lambda: inc.file_stream(spark, src, schema)
        inc.append_run(stream(), path("all"), path("all-state"))
        inc.dedupe_run(stream(), ["id"], "ts", "60 days", path("unique"), path("unique-state"))
        inc.upsert_run(stream(), path("table"), "id", ["ts"], path("table-state"))
        inc.daily_counts_run(stream(), "ts", "id", "1 day", path("days"), path("days-state"))
    batch = spark.read.parquet(src)
    assert spark.read.parquet(path("all")).count() == 6
    assert sorted(r["id"] for r in spark.read.parquet(path("unique")).collect()) == ["a", "b", "c"]
    want = sorted((r["id"], r["n"]) for r in keep_last(batch, ["id"], ["ts"]).collect())
    assert sorted((r["id"], r["n"]) for r in inc.latest(spark, path("table")).collect()) == want
    # February is still open, and the last row came after its day was closed.
    months = inc.monthly_from_days(spark.read.parquet(path("days")), "id")
    assert sorted((r["month"], r["id"], r["ocorrencias"]) for r in months.collect()) == [(1, "a", 3), (1, "b", 1)]
