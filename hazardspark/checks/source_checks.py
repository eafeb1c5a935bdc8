"""Queries over sources and sinks: written below the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardspark.checks import frames as fr
from hazardspark.checks.base import check, table
from hazardspark.checks.extract_checks import ART
from hazardspark.checks.join_checks import _eswd_rows, _report_rows
from hazardspark.operators import filters
from hazardspark.schemas import ARTICLE, ARTICLE_CSV, DISASTER_READY_CSV, EVENT, VICTIMS
from hazardspark.session import fresh_dir
from hazardspark.sinks import files
from hazardspark.sinks import tables as sink_tables
from hazardspark.sources import catalogues, gazetteer, lake, paged, tables

_QUOTED = "replace(title, ': ', ':'||chr(10)||'\"')"


@check(
    "s1_article_csv",
    ART + f"SELECT ID, {_QUOTED} AS title, type, date, year, nullif(parish,'') AS parish, page, fatalities FROM art",
)
def s1(spark, sf):
    """Quoted multi-line titles survive a CSV round trip."""
    a = fr.articles(spark, sf).select(*ARTICLE.fieldNames())
    a = a.withColumn("title", F.replace("title", F.lit(": "), F.lit(':\n"')))
    path = fresh_dir(spark, "articles-csv")
    files.write_csv(a, path, compression="gzip")
    return tables.articles(spark, path).select("ID", "title", "type", "date", "year", "parish", "page", "fatalities")


@check(
    "s1_csv_rejects",
    "SELECT o_orderkey AS id, o_orderkey % 50 IN (1, 2, 3) AS rejected, CASE WHEN o_orderkey % 50 NOT IN (1, 2, 3) THEN o_custkey END AS n FROM orders",
)
def s1b(spark, sf):
    """Every fiftieth order has a bad number, a cell too few or one too many; quoted cells hold line breaks."""
    o, k = table(spark, sf, "orders"), F.col("o_orderkey") % 50
    line = F.concat_ws(
        ",", "o_orderkey", F.when(k == 1, F.lit("x1")).when(k != 2, F.col("o_custkey").cast("string")),
        F.concat(F.lit('"a ""quoted"" cell\n'), "o_orderpriority", F.lit('"')), F.when(k == 3, F.lit("more")),
    )
    path = fresh_dir(spark, "rejects-csv")
    o.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("note", T.StringType())])
    good, bad = tables.csv_with_rejects(spark, path, schema, header=False)
    return good.select("id", F.lit(False).alias("rejected"), "n").unionByName(
        bad.select(F.substring_index("record", ",", 1).cast("long").alias("id"), F.lit(True).alias("rejected"), F.lit(None).cast("long").alias("n"))
    )


@check(
    "s2_eswd_scan",
    "SELECT 'E'||event_id AS \"ID\", ts::DATE AS \"DATE\", strftime(ts,'%H:%M') AS \"HOUR\", 'P'||(event_id%31) AS \"PLACE\" FROM events WHERE event_id % 10 > 0",
)
def s2(spark, sf):
    return catalogues.eswd(_eswd_rows(spark, sf)).select("ID", "DATE", "HOUR", "PLACE")


@check("s3_tabular_scan", "SELECT 'Flood' AS type, o_orderpriority AS subtype, 'M'||o_custkey AS municipality, 'p'||o_orderkey AS page FROM orders")
def s3(spark, sf):
    return catalogues.tabular(_report_rows(spark, sf)).select("type", "subtype", "municipality", "page")


@check(
    "s4_feature_pages",
    "SELECT 'C'||(event_id%50) AS Concelho, 'F'||user_id AS Freguesia, CASE WHEN event_id%3>0 THEN value END AS Latitude, count(*) AS n FROM events WHERE event_id % 6 <> 5 GROUP BY ALL",
)
def s4(spark, sf):
    """Events as pages of 200 feature objects in JSON, filtered by kind and flattened."""
    features = _numbered_features(spark, sf)
    pages = features.groupBy("page").agg(F.collect_list("feature").alias("features"))
    text = pages.select(F.to_json(F.struct("features")).alias("json"))
    out = catalogues.feature_lines(text, "json", "Cheia")
    return out.groupBy("Concelho", "Freguesia", "Latitude").agg(F.count(F.lit(1)).alias("n"))


@check(
    "s4_paged_source",
    "SELECT 'C'||(event_id%50) AS Concelho, 'F'||user_id AS Freguesia, CASE WHEN event_id%3>0 THEN value END AS Latitude, count(*) AS n FROM events WHERE event_id % 6 <> 5 GROUP BY ALL",
)
def s4_paged(spark, sf):
    """The same pages as a folder each, read through the data source with the kind pushed to the page readers."""
    pages = _numbered_features(spark, sf).groupBy("page").agg(F.to_json(F.struct(F.collect_list("feature").alias("features"))).alias("value"))
    path = fresh_dir(spark, "feature-pages")
    pages.write.partitionBy("page").text(path)
    out = paged.read_pages(spark, path + "/page={page}", "Cheia", page_size=200)
    return out.groupBy("Concelho", "Freguesia", "Latitude").agg(F.count(F.lit(1)).alias("n"))


def _numbered_features(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id")
    attributes = F.struct(
        F.when(k % 6 == 5, "Vento").otherwise("Cheia").alias("Natureza"),
        F.concat(F.lit("C"), (k % 50).cast("string")).alias("Concelho"), F.concat(F.lit("F"), "user_id").alias("Freguesia"),
        F.when(k % 3 > 0, F.col("value")).alias("Latitude"),
    )
    return e.select(F.floor(k / 200).alias("page"), F.struct(attributes.alias("attributes")).alias("feature"))


@check(
    "s5_rss_items",
    r"SELECT md5(regexp_replace(url,'[?#].*$','')) AS ID, 'cheias' AS keyword, 'Lisboa' AS localidade, 'Cheia & vento <'||page_id||'>' AS title, url AS link, "
    "'Fri, 24 Jan 2025 07:00:00 GMT' AS published, '2025-01-24' AS collection_date FROM pages WHERE page_id % 5 <> 0",
)
def s5(spark, sf):
    p = table(spark, sf, "pages")
    safe = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    title = F.concat(F.lit("Cheia & vento <"), F.col("page_id").cast("string"), F.lit(">"))
    date = F.when(F.col("page_id") % 5 != 0, "<pubDate>Fri, 24 Jan 2025 07:00:00 GMT</pubDate>").otherwise("")
    xml = F.concat(F.lit("<item><title> "), safe(title), F.lit("</title><link>"), safe(F.col("url")), F.lit("</link>"), date, F.lit("</item>"))
    rows = p.select(F.lit("cheias").alias("keyword"), F.lit("Lisboa").alias("localidade"), F.lit("2025-01-24").alias("collection_date"), xml.alias("xml"))
    return catalogues.rss_items(rows, "xml")


@check("s6_query_table", "SELECT c_custkey, c_mktsegment FROM customer")
def s6(spark, sf):
    return tables.query_table(table(spark, sf, "customer"), "c_custkey, c_mktsegment")


_STAGE = "CASE WHEN l_linenumber = 1 AND month(day_date) % 2 = 0 THEN 'victims' WHEN l_linenumber IN (2,3) AND day(day_date) % 3 > 0 THEN 'no_victims' ELSE 'all' END"


def _staged(spark, sf):
    a = fr.articles(spark, sf)
    k, d = F.col("l_linenumber"), F.col("day_date")
    stage = F.when((k == 1) & (F.month(d) % 2 == 0), "victims").when(k.isin(2, 3) & (F.dayofmonth(d) % 3 > 0), "no_victims").otherwise("all")
    return a.withColumn("stage", stage)


@check(
    "s7_ranked_stage_scan",
    ART + f", s AS (SELECT seq, day_date, year, month, day, {_STAGE} AS stage FROM art), g AS (SELECT day_date, stage, count(*) AS n FROM s GROUP BY ALL), "
    "b AS (SELECT day_date, stage FROM g QUALIFY row_number() OVER (PARTITION BY day_date ORDER BY CASE stage WHEN 'victims' THEN 1 WHEN 'no_victims' THEN 2 ELSE 3 END, n DESC) = 1) SELECT seq, stage FROM s JOIN b USING (day_date, stage)",
)
def s7(spark, sf):
    """Every day's rows from its preferred stage of a written lake."""
    path = fresh_dir(spark, "lake")
    staged = _staged(spark, sf).select("seq", "stage", "year", "month", "day")
    staged.repartition("year", "month").write.partitionBy("stage", "year", "month").parquet(path)
    return lake.best_stage(spark.read.parquet(path), ["year", "month", "day"]).select("seq", "stage")


@check("s8_html_pages")
def s8(spark, sf):
    return catalogues.html_pages(table(spark, sf, "pages")).select("page_id", "text")


def _nested(spark, sf):
    """province -> district -> [municipality] as one map; names are a small fixed set."""
    g = fr.gazetteer(spark, sf).select("province", "district", "municipality").distinct()
    by_district = g.groupBy("province", "district").agg(F.sort_array(F.collect_set("municipality")).alias("m"))
    by_province = by_district.groupBy("province").agg(F.map_from_entries(F.collect_list(F.struct("district", "m"))).alias("d"))
    return by_province.select(F.create_map("province", "d").alias("nested"), F.col("d").alias("flat"))


@check(
    "s9_places_by_province",
    fr.texts(fr.GAZ) + "SELECT province, district, municipality AS place FROM (SELECT DISTINCT province, district, municipality FROM gaz) UNION ALL SELECT DISTINCT province, district, district FROM gaz",
)
def s9(spark, sf):
    return gazetteer.places_by_province(_nested(spark, sf))


@check("s9_municipality_lookup", fr.texts(fr.GAZ) + "SELECT lower(municipality) AS place_key, max(district) AS district, max(municipality) AS municipality FROM gaz GROUP BY 1")
def s9b(spark, sf):
    return gazetteer.municipality_lookup(_nested(spark, sf), "flat")


@check("s10_parish_codes", fr.texts(fr.GAZ) + "SELECT lower(municipality) AS name, arg_max(code, c_custkey) AS code FROM gaz GROUP BY 1")
def s10(spark, sf):
    return gazetteer.parish_codes(fr.gazetteer(spark, sf), "municipality", "code", ["c_custkey"])


@check("s10_parish_codes_nested", "SELECT lower(n_name) AS name, lpad(n_nationkey::VARCHAR,4,'0') AS code FROM nation")
def s10b(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    parish = F.struct(F.col("n_name").alias("nome"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("codigo"))
    nested = n.select(F.create_map("r_name", F.create_map(F.lower("n_name"), F.array(parish))).alias("nested"))
    return gazetteer.parish_codes_nested(nested)


@check("s11_vocabulary_config", "SELECT 'keyword' AS kind, p_type AS name FROM part GROUP BY p_type UNION ALL SELECT 'storm', p_brand FROM part GROUP BY p_brand")
def s11(spark, sf):
    """Vocabulary files written from the part table and read back."""
    p = table(spark, sf, "part")
    kw, names = fresh_dir(spark, "keywords"), fresh_dir(spark, "names")
    terms = F.create_map(F.lit("portuguese"), F.sort_array(F.collect_set("p_type")))
    p.agg(F.to_json(F.struct(terms.alias("weather_terms"))).alias("value")).write.text(kw)
    p.agg(F.to_json(F.sort_array(F.collect_set("p_brand"))).alias("value")).write.text(names)
    a = gazetteer.keywords(spark, kw).select(F.lit("keyword").alias("kind"), F.col("keyword").alias("name"))
    return a.unionByName(gazetteer.name_list(spark, names).select(F.lit("storm").alias("kind"), "name"))


@check(
    "s12_centroid_layers",
    fr.texts(fr.CEN) + "SELECT latitude, longitude, coalesce(freguesia, concelho, 'distrito_centroid') AS name, CASE WHEN concelho IS NULL THEN 'Portugal' ELSE distrito END AS region, distrito, concelho, freguesia, dicofre, "
    "CASE WHEN freguesia IS NOT NULL THEN 12.5::DOUBLE END AS area_ha, CASE WHEN freguesia IS NOT NULL THEN 'freguesia' WHEN concelho IS NOT NULL THEN 'concelho' ELSE 'distrito' END AS centroid_type, count(*) AS n FROM cen GROUP BY ALL",
)
def s12(spark, sf):
    c = fr.centroids(spark, sf)
    parish = c.where("freguesia IS NOT NULL").select(
        "latitude", "longitude", F.col("freguesia").alias("Freguesia"), F.col("concelho").alias("Concelho"), F.col("distrito").alias("Distrito"),
        F.col("dicofre").alias("Dicofre"), F.lit(12.5).alias("AREA_T_Ha"), F.lit("x").alias("TAA"),
    )
    town = c.where("freguesia IS NULL AND concelho IS NOT NULL").select(
        "latitude", "longitude", F.col("concelho").alias("NAME_2"), F.col("distrito").alias("NAME_1"), F.col("dicofre").alias("CCA_2"), F.lit("Portugal").alias("NAME_0"),
    )
    district = c.where("concelho IS NULL").select("latitude", "longitude", "distrito", "dicofre")
    out = gazetteer.centroid_table(
        gazetteer.centroid_layer(parish, "freguesia"), gazetteer.centroid_layer(town, "concelho"), gazetteer.centroid_layer(district, "distrito")
    )
    keys = [c for c in out.columns if c != "cluster_id"]
    return out.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@check(
    "s13_labelled_spans",
    ART + "SELECT title AS text, length(term)::INTEGER AS start, (length(term)+3)::INTEGER AS \"end\", upper(label) AS label, ' em' AS span, count(*) AS n FROM art GROUP BY ALL",
)
def s13(spark, sf):
    a = fr.articles(spark, sf)
    at = F.length("term")
    entity = F.struct(at.alias("start"), (at + 3).alias("end"), F.upper("label").alias("label"))
    path = fresh_dir(spark, "spans")
    a.select(F.col("title").alias("text"), F.array(entity).alias("entities")).write.json(path)
    out = gazetteer.labelled_spans(spark, path, multi_line=False)
    return out.groupBy("text", "start", "end", "label", "span").agg(F.count(F.lit(1)).alias("n"))


# --- sinks -----------------------------------------------------------------------------------


def _text_schema(names):
    return ", ".join(f"`{n}` string" for n in names)


@check(
    "k1_fixed_projection_csv",
    ART + "SELECT ID, type, subtype, date, year::VARCHAR AS year, month::VARCHAR AS month, day::VARCHAR AS day, hour, georef, district, municipali, nullif(parish,'') AS parish, NULL::VARCHAR AS DICOFREG, source, sourcedate, sourcetype, page, "
    + ", ".join(f"{v}::VARCHAR AS {v}" for v in VICTIMS) + " FROM art",
)
def k1(spark, sf):
    a = fr.articles(spark, sf).drop("DICOFREG")
    path = fresh_dir(spark, "csv")
    files.write_csv(files.fixed_projection(a), path, compression="gzip")
    return tables.csv_table(spark, path, _text_schema(ARTICLE_CSV))


@check(
    "k1_disaster_ready",
    ART + "SELECT ID, title, date, type, subtype, district, municipali, parish, DICOFREG AS dicofreg, hour, source, '' AS link_extraido, " + ", ".join(f"{v}::VARCHAR AS {v}" for v in VICTIMS)
    + f", sourcetype FROM art WHERE greatest({','.join(VICTIMS)}) > 0",
)
def k1b(spark, sf):
    a = fr.articles(spark, sf).withColumnRenamed("DICOFREG", "dicofreg")
    return files.disaster_ready(a).select(*DISASTER_READY_CSV)


@check(
    "k2_dynamic_projection",
    ART + "SELECT ID, type, page, fatalities::VARCHAR AS fatalities, '2' AS aaa_extra, title, phrase AS zzz_extra FROM art",
)
def k2(spark, sf):
    a = fr.articles(spark, sf).select(F.col("phrase").alias("zzz_extra"), "fatalities", "title", "page", "ID", F.lit(2).alias("aaa_extra"), "type")
    out = files.dynamic_projection(a)
    if out.columns != ["ID", "type", "page", "fatalities", "aaa_extra", "title", "zzz_extra"]:
        raise ValueError(f"unexpected column order {out.columns}")
    return out


@check(
    "k3_dated_lake",
    "SELECT event_id, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day FROM events WHERE ts::DATE <> DATE '2024-01-05' "
    "UNION ALL SELECT event_id + 1000000000, 2024, 1, 5 FROM events WHERE ts::DATE = DATE '2024-01-05'",
)
def k3(spark, sf):
    """Whole table by day, one day replaced afterwards."""
    path = fresh_dir(spark, "dated")
    e = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("d"))
    files.write_dated(e, path, F.col("d"))
    again = lake.on_day(spark.read.parquet(path), "2024-01-05").withColumn("event_id", F.col("event_id") + 1000000000)
    files.write_dated(again.select("event_id", "d"), path, F.col("d"))
    return spark.read.parquet(path).select("event_id", "year", "month", "day")


@check("k3_date_of_file_name", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN o_orderdate::DATE END AS file_date FROM orders")
def k3b(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey") % 3
    name = F.concat(
        F.lit("/lake/raw/artigos_"), F.when(k == 0, F.date_format("o_orderdate", "yyyyMMdd")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("hoje"), F.lit(".csv")
    )
    return o.select("o_orderkey", lake.date_of_file(name).alias("file_date"))


@check("k4_routed_outputs", ART + "SELECT route, count(*) AS n, sum(n)::BIGINT AS total FROM (SELECT CASE WHEN type <> 'Storm' OR greatest(fatalities,injured) > 0 THEN 'relevant' ELSE 'irrelevant' END AS route, n FROM art) GROUP BY route")
def k4(spark, sf):
    a = fr.articles(spark, sf).withColumns({v: F.lit(0) for v in VICTIMS if v not in ("fatalities", "injured")})
    a = a.withColumn("type", F.when(F.col("type") == "Storm", "Other").otherwise(F.col("type")))
    path = fresh_dir(spark, "routed")
    files.write_routed(a, path, filters.route(F.col("type")), ["seq", "n", "type", *VICTIMS])
    return spark.read.parquet(path).groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total"))


@check("k5_append_and_snapshot", "SELECT 'history' AS t, count(*) AS n FROM orders UNION ALL SELECT 'latest', count(*) FROM orders WHERE o_orderkey % 2 = 1")
def k5(spark, sf):
    history, latest = fresh_dir(spark, "history"), fresh_dir(spark, "latest")
    o = table(spark, sf, "orders")
    for part in (0, 1):
        files.append_and_snapshot(o.where(F.col("o_orderkey") % 2 == part), history, latest)
    n = lambda path, name: spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n")
    return n(history, "history").unionByName(n(latest, "latest"))


@check("k9_run_record", ART + "SELECT 'artigos_filtrados_20250605_staging' AS table_name, 'sucesso' AS status, (SELECT count(*) FROM lineitem) AS input_rows, (SELECT count(*) FROM art WHERE type IN ('Flood','Landslide')) AS exported_rows, DATE '2025-06-05' AS run_date")
def k9(spark, sf):
    l = fr.articles(spark, sf)
    record = sink_tables.run_record(
        l.where(filters.known_hazard(F.col("type"))), sink_tables.staging_name("2025-06-05"), l.agg(F.count(F.lit(1))).scalar(), "2025-06-05", F.current_timestamp()
    )
    return record.drop("recorded_at")


@check("k10_export_tables", "SELECT 'customer' AS t, count(*) AS n FROM customer UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'orders', count(*) FROM orders")
def k10(spark, sf):
    path = fresh_dir(spark, "export")
    names = ["customer", "nation", "orders"]
    files.export_tables({n: table(spark, sf, n) for n in names}, path)
    out = None
    for n in names:
        part = spark.read.parquet(f"{path}/{n}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("t"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@check("k11_load_located", fr.texts(fr.LOC) + "SELECT id, latitude, count(*) AS n FROM loc, (SELECT unnest([1,2])) WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL")
def k11(spark, sf):
    path = fresh_dir(spark, "centroids")
    loc = fr.locations(spark, sf)
    sink_tables.load(loc, path, "replace")
    sink_tables.load(loc, path, "append")
    return spark.read.parquet(path).groupBy("id", "latitude").agg(F.count(F.lit(1)).alias("n"))


@check("k12_empty_result", "SELECT o_orderkey::VARCHAR AS id, o_orderstatus AS type FROM orders WHERE o_orderstatus IN ('Flood','Landslide')")
def k12(spark, sf):
    """No order's status is a hazard: all are read, none is left."""
    path = fresh_dir(spark, "empty")
    none = table(spark, sf, "orders").where(filters.known_hazard(F.col("o_orderstatus"))).select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("type"))
    files.write_empty(spark, EVENT, path)
    return none.unionByName(spark.read.schema(EVENT).parquet(path).select("id", "type"))
