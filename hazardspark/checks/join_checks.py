"""Queries over joins, anti joins, georeferencing, upsert, star and catalogue operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardspark import vocab
from hazardspark.checks import frames as fr
from hazardspark.checks.base import check, documents, table
from hazardspark.checks.extract_checks import ART, hazard_sql, title_counts_sql
from hazardspark.functions import text as T
from hazardspark.operators import catalog, dedupe, filters, geo, report
from hazardspark.operators.upsert import upsert
from hazardspark.plans import news, publication
from hazardspark.schemas import EVENT, VICTIMS
from hazardspark.sinks import tables as sink_tables
from hazardspark.sources import gazetteer



def _stamp():
    return F.lit("2025-01-01 00:00:00").cast("timestamp")



@check(
    "j1_impacts_and_location",
    fr.texts(fr.DIS, fr.IMP, fr.LOC) + "SELECT dis.id, dis.type, coalesce(fatalities,0)::BIGINT AS fatalities, district FROM dis LEFT JOIN imp USING (id) LEFT JOIN loc ON loc.id = dis.id",
)
def j1(spark, sf):
    loc = fr.locations(spark, sf)
    return report.with_impacts(fr.disasters(spark, sf), fr.impacts(spark, sf), loc).select("id", "type", "fatalities", "district")


@check(
    "j2_mapped_disasters",
    fr.texts(fr.DIS, fr.LOC) + f"SELECT id, latitude, longitude, {fr.title_sql('trim(district)')} AS district, {fr.title_sql('municipality')} AS municipality FROM dis JOIN loc USING (id)",
)
def j2(spark, sf):
    loc = fr.locations(spark, sf)
    return report.mapped(fr.disasters(spark, sf), loc).select("id", "latitude", "longitude", "district", "municipality")


_LEVELS_SQL = ", ".join(
    f"{t} AS (SELECT lower(trim({c})) AS k, arg_min({{'lat': latitude, 'lon': longitude}}, (coalesce(dicofre,''), latitude, longitude)) AS p FROM cen WHERE {c} IS NOT NULL GROUP BY 1)"
    for c, t in (("freguesia", "lf"), ("concelho", "lc"), ("distrito", "ld"))
)
_LOCATE_SQL = (
    "coalesce(lf.p, lc.p, ld.p) AS p, CASE WHEN lf.p IS NOT NULL THEN 'freguesia' WHEN lc.p IS NOT NULL THEN 'concelho' WHEN ld.p IS NOT NULL THEN 'distrito' END AS lev"
)


def _unlocated(spark, sf):
    a = fr.articles(spark, sf)
    has = F.col("l_linenumber") == 7
    return a.select(
        "seq", F.concat(F.lit(" "), F.upper("parish")).alias("parish"), F.col("municipali").alias("municipality"), "district",
        F.when(has, 40.0).alias("latitude"), F.when(has, -7.5).alias("longitude"), F.lit("unknown").alias("georef_class"),
    )


@check(
    "j3_centroid_lookup",
    fr.texts(fr.ART, fr.CEN) + f", {_LEVELS_SQL}, j AS (SELECT a.seq, l_linenumber = 7 AS has, {_LOCATE_SQL} FROM art a LEFT JOIN lf ON lf.k = lower(a.parish) LEFT JOIN lc ON lc.k = lower(a.municipali) LEFT JOIN ld ON ld.k = lower(a.district)) "
    "SELECT seq, CASE WHEN has THEN 40.0::DOUBLE ELSE p.lat END AS latitude, CASE WHEN has THEN -7.5::DOUBLE ELSE p.lon END AS longitude, CASE WHEN has OR p IS NULL THEN 'unknown' ELSE lev END AS georef_class FROM j",
)
def j3(spark, sf):
    out = geo.locate(_unlocated(spark, sf), fr.centroids(spark, sf))
    return out.select("seq", "latitude", "longitude", "georef_class")


@check(
    "j4_municipality_point",
    fr.texts(fr.ART, fr.CEN) + ", m AS (SELECT lower(distrito) AS d, lower(concelho) AS c, arg_min({'lat': latitude, 'lon': longitude}, (coalesce(dicofre,''), latitude, longitude)) AS p FROM cen WHERE concelho IS NOT NULL GROUP BY 1,2) "
    "SELECT seq, coalesce(p.lat, 39.5::DOUBLE) AS latitude, coalesce(p.lon, -8.0::DOUBLE) AS longitude, CASE WHEN p IS NULL THEN 0 ELSE 3 END AS georef_class FROM art LEFT JOIN m ON d = lower(district) AND c = lower(municipali)",
)
def j4(spark, sf):
    a = fr.articles(spark, sf).select("seq", "district", F.col("municipali").alias("municipality"), F.lit(3).alias("georef_class"))
    return geo.municipality_point(a, fr.centroids(spark, sf)).select("seq", "latitude", "longitude", "georef_class")


_ALIASES = {"NATION_1 BUILDING": ("Alias A", "Town A"), "NATION_2 MACHINERY": ("Alias B", "Town B"), **vocab.REGION_ALIASES}


@check(
    "j5_assign_district",
    ART + ", k AS (SELECT lower(CASE WHEN n_nationkey % 4 = 3 THEN 'Old ' ELSE '' END||n_name||' '||c_mktsegment) AS key, min((n_name, (CASE WHEN n_nationkey % 4 = 3 THEN 'Old ' ELSE '' END||n_name||' '||c_mktsegment))) AS m FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1) "
    "SELECT seq, CASE municipali WHEN 'NATION_1 BUILDING' THEN 'Alias A' WHEN 'NATION_2 MACHINERY' THEN 'Alias B' ELSE coalesce(m[1], 'Desconhecido') END AS district, "
    "CASE municipali WHEN 'NATION_1 BUILDING' THEN 'Town A' WHEN 'NATION_2 MACHINERY' THEN 'Town B' ELSE coalesce(m[2], municipali) END AS municipality, "
    "CASE WHEN municipali IN ('NATION_1 BUILDING','NATION_2 MACHINERY') THEN 2 WHEN m IS NOT NULL THEN 3 ELSE 0 END AS georef_class FROM art LEFT JOIN k ON key = lower(municipali)",
)
def j5(spark, sf):
    a = fr.articles(spark, sf).select("seq", F.col("municipali").alias("Location"))
    m = fr.renamed(fr.gazetteer(spark, sf), "municipality", F.col("n_nationkey") % 4 == 3).select("district", "municipality").distinct()
    return geo.assign_district(a, m, aliases=_ALIASES).select("seq", "district", "municipality", "georef_class")


# Reports at the customer's point; every fifth is moved by less, every seventh by more than the tolerance.
_NEAR_SQL = (
    "rep AS (SELECT o_orderkey, o_orderstatus AS type, o_orderdate::DATE AS date, o_orderpriority AS hour, n_name AS municipality, c_mktsegment AS parish, "
    "round(37.0::DOUBLE + (c_custkey % 500)/100.0::DOUBLE, 2) + CASE WHEN o_orderkey % 5 = 0 THEN 0.000004::DOUBLE WHEN o_orderkey % 7 = 0 THEN 0.00003::DOUBLE ELSE 0 END AS latitude, "
    "round(-9.0::DOUBLE + (c_custkey % 250)/100.0::DOUBLE, 2) AS longitude, extract('month' FROM o_orderdate)::INTEGER AS mon FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey)"
)
_NEAR_KEYS = ["type", "hour", "municipality", "parish"]


def _reports(spark, sf):
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    k, ok = F.col("c_custkey"), F.col("o_orderkey")
    shift = F.when(ok % 5 == 0, 0.000004).when(ok % 7 == 0, 0.00003).otherwise(0.0)
    return o.join(c, F.col("o_custkey") == k).join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "o_orderkey", F.col("o_orderstatus").alias("type"), F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("hour"),
        F.col("n_name").alias("municipality"), F.col("c_mktsegment").alias("parish"),
        (F.round(F.lit(37.0) + (k % 500) / 100, 2) + shift).alias("latitude"), F.round(F.lit(-9.0) + (k % 250) / 100, 2).alias("longitude"),
        F.month("o_orderdate").alias("mon"),
    )


@check(
    "j6_near_duplicate_anti_join",
    "WITH " + _NEAR_SQL + " SELECT o_orderkey FROM rep a WHERE o_orderkey % 2 = 1 AND NOT EXISTS (SELECT 1 FROM rep b WHERE b.o_orderkey % 2 = 0 AND a.type=b.type AND a.hour=b.hour AND a.municipality=b.municipality AND a.parish=b.parish "
    "AND abs(a.latitude-b.latitude) < 0.00001 AND abs(a.longitude-b.longitude) < 0.00001)",
)
def j6(spark, sf):
    r = _reports(spark, sf)
    return dedupe.drop_near_matches(
        r.where("o_orderkey % 2 = 1"), r.where("o_orderkey % 2 = 0"), _NEAR_KEYS, "latitude", "longitude"
    ).select("o_orderkey")


@check(
    "j6_near_repeats_in_batch",
    # Shifts leave clusters of two points more than a tolerance apart, so "no earlier near row" and the sequential reading agree.
    "WITH " + _NEAR_SQL + " SELECT o_orderkey FROM rep a WHERE NOT EXISTS (SELECT 1 FROM rep b WHERE b.o_orderkey < a.o_orderkey AND a.type=b.type AND a.hour=b.hour AND a.municipality=b.municipality AND a.parish=b.parish "
    "AND abs(a.latitude-b.latitude) < 0.00001 AND abs(a.longitude-b.longitude) < 0.00001)",
)
def j6b(spark, sf):
    return dedupe.drop_near_repeats(_reports(spark, sf), _NEAR_KEYS, "latitude", "longitude", "o_orderkey").select("o_orderkey")


@check("j7_not_yet_seen", ART + "SELECT seq FROM art WHERE page NOT IN (SELECT page FROM art WHERE l_orderkey % 3 = 0)")
def j7(spark, sf):
    a = fr.articles(spark, sf)
    return dedupe.not_yet_seen(a, a.where("l_orderkey % 3 = 0"), "page").select("seq")


_PLAN_KW = ["inundação", "cheias", "chuva"]
_PLAN_BASE = (
    f"p AS (SELECT localidade, keyword, keyword IN ('inundação','chuva') AS prio, md5('s|'||keyword||'|'||localidade) AS h FROM (SELECT r_name||' '||c_name AS localidade FROM customer JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey), "
    f"(SELECT unnest({_PLAN_KW}) AS keyword)), r AS (SELECT *, row_number() OVER (PARTITION BY prio ORDER BY h) AS rn, count(*) FILTER (WHERE prio) OVER () AS np FROM p) "
)


@check(
    "j8_search_plan",
    "WITH " + _PLAN_BASE + "SELECT localidade, keyword, h AS position_key, CASE WHEN NOT prio THEN 1 WHEN rn <= floor(np*0.3) THEN 0 ELSE 2 END AS block FROM r",
)
def j8(spark, sf):
    g = fr.gazetteer(spark, sf).select(F.concat_ws(" ", "province", "parish").alias("localidade"))
    return report.search_plan(_PLAN_KW, g, days=3, seed="s")


@check(
    "j9_allocation_join",
    ART + ", h AS (SELECT district, type, count(*) AS count, avg(n) AS m FROM art GROUP BY 1,2), f AS (SELECT type, sum(n)::BIGINT AS ocorrencias FROM art WHERE type <> 'Storm' GROUP BY 1) "
    "SELECT h.district, h.type, count, ocorrencias, round(m,4) AS mean_n FROM h LEFT JOIN f ON h.type = f.type WHERE m IS NOT NULL",
)
def j9(spark, sf):
    a = fr.articles(spark, sf).select("district", "type", "n", "l_linenumber")
    h = a.groupBy("district", "type").agg(F.count(F.lit(1)).alias("count"), F.round(F.avg("n"), 4).alias("mean_n"))
    f = a.where("type <> 'Storm'").groupBy("type").agg(F.sum("n").alias("ocorrencias"))
    return h.join(f, "type", "left").dropna(subset=["mean_n"]).select("district", "type", "count", "ocorrencias", "mean_n")


_J10 = (
    "rep AS (SELECT seq, district, day_date AS d, fatalities+injured AS v FROM art WHERE l_linenumber % 2 = 0), "
    "nw AS (SELECT DISTINCT district, day_date AS d, fatalities+injured AS v FROM art WHERE l_linenumber % 2 = 1), "
    "j AS (SELECT rep.seq, rep.district, EXISTS (SELECT 1 FROM nw WHERE nw.district = rep.district AND nw.v = rep.v AND abs(date_diff('day', nw.d, rep.d)) <= 2) AS confirmed FROM rep)"
)


@check(
    "j10_cross_validation",
    ART + f", {_J10} SELECT district, count(*) AS reports, count_if(confirmed)::BIGINT AS confirmed, round(count_if(confirmed)/count(*),4) AS share FROM j GROUP BY district",
)
def j10(spark, sf):
    a = fr.articles(spark, sf).select("l_linenumber", "district", F.col("day_date").alias("date"), (F.col("fatalities") + F.col("injured")).alias("victims"))
    rows = report.confirmed_share(a.where("l_linenumber % 2 = 0"), a.where("l_linenumber % 2 = 1"))
    n, c = F.count(F.lit(1)), F.count_if("confirmed")
    return rows.groupBy("district").agg(n.alias("reports"), c.alias("confirmed"), F.round(c / n, 4).alias("share"))


@check(
    "j11_enrich_place",
    ART + ", pl AS (SELECT lower(CASE WHEN n_nationkey % 3 = 1 THEN 'Old ' ELSE '' END||n_name||' '||c_mktsegment) AS k, max(n_name) AS d, max(CASE WHEN n_nationkey % 3 = 1 THEN 'Old ' ELSE '' END||n_name||' '||c_mktsegment) AS m, max(lpad(c_custkey::VARCHAR,6,'0')) AS code FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1) "
    "SELECT seq, coalesce(d,'') AS district, coalesce(m,'') AS municipality, coalesce(code,'') AS DICOFREG FROM (SELECT seq, localidade FROM art) LEFT JOIN pl ON k = lower(localidade)",
)
def j11(spark, sf):
    a = fr.articles(spark, sf).select("seq", F.col("localidade").alias("loc"))
    g = fr.renamed(fr.gazetteer(spark, sf), "municipality", F.col("n_nationkey") % 3 == 1)
    places = g.groupBy(F.lower("municipality").alias("place_key")).agg(F.max("district").alias("district"), F.max("municipality").alias("municipality"))
    codes = gazetteer.parish_codes(g, "municipality", "code", ["code"])
    return geo.enrich_place(a, places, codes).select("seq", "district", "municipality", "DICOFREG")


@check(
    "j12_exists_flag",
    "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O' AND o_totalprice > 400000) AS has_big FROM customer",
)
def j12(spark, sf):
    big = table(spark, sf, "orders").where("o_orderstatus = 'O' AND o_totalprice > 400000")
    flags = big.select(F.col("o_custkey").cast("string").alias("k"))
    c = table(spark, sf, "customer").withColumn("k", F.col("c_custkey").cast("string"))
    return filters._flag_known(c, "k", flags, "has_big").select("c_custkey", "has_big")


_WORDS_SQL = "SELECT DISTINCT substr(lower(c_mktsegment),1,3) AS w FROM customer UNION SELECT DISTINCT split_part(p_name,' ',2) FROM part"


@check("j13_text_contains_place", f"SELECT doc_id, w AS place FROM documents JOIN ({_WORDS_SQL}) ON contains({fr.norm_sql('text')}, w)")
def j13(spark, sf):
    seg = table(spark, sf, "customer").select(F.substring(F.lower("c_mktsegment"), 1, 3).alias("w"))
    names = seg.union(table(spark, sf, "part").select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("w"))).distinct()
    docs = documents(spark, sf).select("doc_id", "text")
    return geo.places_in_text(docs, "doc_id", "text", names.withColumn("rank", F.col("w")), "w", "rank").select("doc_id", "place")


# --- dedupe ----------------------------------------------------------------------------------


@check("w3_keep_first_page", ART + "SELECT page, min(seq) AS seq FROM art GROUP BY page")
def w3a(spark, sf):
    return dedupe.keep_first(fr.articles(spark, sf).select("seq", "page"), ["page"], ["seq"]).select("page", "seq")


@check(
    "w3_keep_first_content",
    ART + ", p AS (SELECT * FROM art QUALIFY row_number() OVER (PARTITION BY page ORDER BY seq) = 1) SELECT seq FROM p QUALIFY row_number() OVER (PARTITION BY district, parish, date, fatalities, injured ORDER BY seq) = 1",
)
def w3b(spark, sf):
    a = fr.articles(spark, sf).select("seq", "page", "district", "parish", "date", "fatalities", "injured")
    return dedupe.dedupe_articles(a, ["seq"]).select("seq")


@check(
    "w3_title_then_url",
    ART + ", t AS (SELECT * FROM art QUALIFY row_number() OVER (PARTITION BY md5(lower(title)) ORDER BY seq) = 1) SELECT seq FROM t QUALIFY row_number() OVER (PARTITION BY split_part(link,'?',1) ORDER BY seq) = 1",
)
def w3c(spark, sf):
    return dedupe.keep_first_title_then_url(fr.articles(spark, sf).select("seq", "title", "link"), "title", "link", "seq").select("seq")


@check("w3_title_or_url_exact")
def w3d(spark, sf):
    return dedupe.keep_first_title_or_url(fr.articles(spark, sf).select("seq", "title", "link"), "title", "link", "seq").select("seq")


@check("w6_last_write_wins", ART + "SELECT page, max(seq) AS seq, arg_max(title, seq) AS title FROM art GROUP BY page")
def w6(spark, sf):
    return dedupe.keep_last(fr.articles(spark, sf).select("seq", "page", "title"), ["page"], ["seq"]).select("page", "seq", "title")


# --- upsert, star, publication ---------------------------------------------------------------


@check(
    "k7_upsert",
    "WITH t AS (SELECT o_orderkey AS id, o_orderstatus AS type, o_totalprice AS price, o_orderpriority AS note FROM orders WHERE o_orderkey % 3 <> 0), "
    "s AS (SELECT o_orderkey AS id, 'new' AS type, o_totalprice+1 AS price, 'src' AS note FROM orders WHERE o_orderkey % 3 <> 1) "
    "SELECT coalesce(t.id,s.id) AS id, CASE WHEN s.id IS NULL THEN t.type ELSE s.type END AS type, CASE WHEN t.id IS NULL THEN s.price ELSE t.price END AS price, CASE WHEN t.id IS NULL THEN s.note ELSE t.note END AS note FROM t FULL JOIN s ON t.id=s.id",
)
def k7(spark, sf):
    o = table(spark, sf, "orders")
    cols = lambda a, b, c: [F.col("o_orderkey").alias("id"), a.alias("type"), b.alias("price"), c.alias("note")]
    t = o.where("o_orderkey % 3 <> 0").select(*cols(F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderpriority")))
    s = o.where("o_orderkey % 3 <> 1").select(*cols(F.lit("new"), F.col("o_totalprice") + 1, F.lit("src")))
    s = s.unionByName(s.withColumn("type", F.lit("old"))).withColumn("load", F.when(F.col("type") == "new", 2).otherwise(1))
    return upsert(t, s, "id", ["type"], order=["load"])


def _catalogue(spark, sf):
    """EM-DAT-like rows from orders."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    nation = lambda m: F.concat(F.lit("NATION_"), (k % m).cast("string"))
    where = (
        F.when(k % 4 == 0, F.concat_ws(", ", nation(25), nation(7)))
        .when(k % 4 == 1, F.concat(nation(25), F.lit(" and "), nation(11), F.lit(" districts, Oeste (x)")))
        .when(k % 4 == 2, F.concat(F.lit("(tudo), "), F.lit("")))
        .otherwise(F.lit("Ilha Da Madeira"))
    )
    return o.select(
        "o_orderkey", F.when(k % 5 == 0, "Spain").otherwise("PORTUGAL").alias("Country"),
        F.when(F.col("o_orderstatus") == "P", "Storm").otherwise("Flood").alias("Disaster Type"),
        F.when(k % 2 == 0, "Flash flood").alias("Disaster Subtype"), where.alias("Location"),
        F.year("o_orderdate").cast("double").alias("Start Year"), F.when(k % 3 > 0, F.month("o_orderdate")).cast("double").alias("Start Month"),
        F.when(k % 7 > 0, F.dayofmonth("o_orderdate")).cast("double").alias("Start Day"),
        F.floor(F.col("o_totalprice") / 1000).cast("double").alias("Total Deaths"),
        F.when(k % 6 > 0, F.floor(F.col("o_totalprice") / 777)).cast("double").alias("No. Injured"),
        (k % 13).cast("double").alias("No. Homeless"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("Entry Date"),
    )


_PARTS_CTE = (
    "c AS (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN ['NATION_'||(o_orderkey%25), 'NATION_'||(o_orderkey%7)] WHEN 1 THEN ['NATION_'||(o_orderkey%25), 'NATION_'||(o_orderkey%11), 'Oeste'] "
    "WHEN 2 THEN [] ELSE ['Funchal'] END AS parts, floor(o_totalprice/1000)::BIGINT AS deaths, CASE WHEN o_orderkey % 6 > 0 THEN floor(o_totalprice/777)::BIGINT ELSE 0 END AS inj, (o_orderkey%13)::BIGINT AS home FROM orders), "
    "e AS (SELECT c.*, p.pos - 1 AS pos, parts[p.pos] AS loc, len(parts) AS k FROM c, LATERAL (SELECT unnest(range(1, len(parts)+1)) AS pos) p)"
)


def _share_sql(x: str) -> str:
    return f"({x} // k + CASE WHEN pos < {x} % k THEN 1 ELSE 0 END)"


@check(
    "a14_expand_locations",
    "WITH " + _PARTS_CTE + f" SELECT o_orderkey, loc AS location, k::INTEGER AS split_count, {_share_sql('deaths')} AS split_deaths, {_share_sql('inj')} AS split_injured, {_share_sql('home')} AS split_homeless FROM e",
)
def a14(spark, sf):
    return catalog.expand_locations(_catalogue(spark, sf)).select(
        "o_orderkey", F.col("Location").alias("location"), "split_count", "split_deaths", "split_injured", "split_homeless"
    )


_EMDAT_SQL = (
    "WITH " + _PARTS_CTE + ", " + fr.CEN + ", mun AS (SELECT DISTINCT lower(CASE WHEN n_nationkey >= 20 THEN 'Old ' ELSE '' END||district) AS key, district, CASE WHEN n_nationkey >= 20 THEN 'Old ' ELSE '' END||district AS mname FROM gaz), "
    "m AS (SELECT lower(distrito) AS d, lower(concelho) AS c, arg_min({'lat': latitude, 'lon': longitude}, (coalesce(dicofre,''), latitude, longitude)) AS p FROM cen WHERE concelho IS NOT NULL GROUP BY 1,2), "
    "x AS (SELECT e.*, CASE loc WHEN 'Oeste' THEN 'Leiria' WHEN 'Funchal' THEN 'Madeira' ELSE coalesce(mun.district,'Desconhecido') END AS district, CASE loc WHEN 'Oeste' THEN 'Caldas da Rainha' WHEN 'Funchal' THEN 'Funchal' ELSE coalesce(mun.mname, loc) END AS municipality, "
    "CASE WHEN loc IN ('Oeste','Funchal') THEN 2 WHEN mun.district IS NOT NULL THEN 3 ELSE 0 END AS cls FROM e LEFT JOIN mun ON mun.key = lower(loc) WHERE o_orderkey % 5 <> 0 AND o_orderstatus <> 'P') "
)


@check(
    "u2_emdat_events",
    _EMDAT_SQL + f"SELECT o.type, subtype, date, year, month, day, hour, latitude, longitude, georef_class, district, municipality, parish, fatalities, injured, displaced, source_date, count(*) AS n FROM (SELECT 'Flood' AS type, CASE WHEN o_orderkey % 2 = 0 THEN 'Flash flood' ELSE 'General flood' END AS subtype, "
    "try_cast(year(o_orderdate)||'-'||lpad((CASE WHEN o_orderkey%3>0 THEN month(o_orderdate) ELSE 1 END)::VARCHAR,2,'0')||'-'||lpad((CASE WHEN o_orderkey%7>0 THEN day(o_orderdate) ELSE 1 END)::VARCHAR,2,'0') AS DATE) AS date, year(o_orderdate)::INTEGER AS year, "
    "(CASE WHEN o_orderkey%3>0 THEN month(o_orderdate) ELSE 1 END)::INTEGER AS month, (CASE WHEN o_orderkey%7>0 THEN day(o_orderdate) ELSE 1 END)::INTEGER AS day, '00:00-00:00' AS hour, coalesce(p.lat, 39.5::DOUBLE) AS latitude, coalesce(p.lon, -8.0::DOUBLE) AS longitude, "
    f"CASE WHEN p IS NULL THEN 0 ELSE cls END AS georef_class, district, municipality, loc AS parish, {_share_sql('deaths')}::INTEGER AS fatalities, {_share_sql('inj')}::INTEGER AS injured, {_share_sql('home')}::INTEGER AS displaced, o_orderdate::DATE AS source_date "
    "FROM x LEFT JOIN m ON m.d = lower(district) AND m.c = lower(municipality)) o GROUP BY ALL",
)
def u2_emdat(spark, sf):
    known = fr.renamed(fr.gazetteer(spark, sf).withColumn("municipality", F.col("district")), "municipality", F.col("n_nationkey") >= 20).select("district", "municipality").distinct()
    events = catalog.emdat_events(_catalogue(spark, sf), known, fr.centroids(spark, sf))
    keys = ["type", "subtype", "date", "year", "month", "day", "hour", "latitude", "longitude", "georef_class", "district", "municipality", "parish", "fatalities", "injured", "displaced", "source_date"]
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _eswd_rows(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id")
    return e.select(
        F.concat(F.lit("E"), "event_id").alias(" id "), F.when(k % 10 > 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("time_event"),
        F.when(k % 4 > 0, F.upper("event_type")).alias("type_event "), F.concat(F.lit(" S"), (k % 9).cast("string")).alias("State"),
        F.concat(F.lit("P"), (k % 31).cast("string")).alias("PLACE"), F.when(k % 3 == 0, "nan").when(k % 3 == 1, F.concat(F.lit(" D"), "user_id")).alias("detailed_location"),
        F.when(k % 7 > 0, F.col("value")).alias("latitude"), (-F.col("value")).alias("longitude"), (k % 5).alias("fatalities"), F.lit(None).cast("int").alias("injured"),
        F.lit("news ").alias("info_source"), F.concat(F.lit("http://e/"), "event_id").alias("ext_url"),
    )


_ESWD_SQL = (
    "SELECT coalesce(CASE WHEN event_id % 4 > 0 THEN upper(event_type) END, 'unknown') AS type, 'Heavy Rain' AS subtype, ts::DATE AS date, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day, strftime(ts,'%H:%M') AS hour, "
    "CASE WHEN event_id % 7 > 0 THEN value END AS latitude, CASE WHEN event_id % 7 > 0 THEN -value END AS longitude, 'S'||(event_id%9) AS district, 'P'||(event_id%31) AS municipality, CASE WHEN event_id%3=1 THEN 'D'||user_id ELSE 'P'||(event_id%31) END AS parish, "
    "(event_id%5)::INTEGER AS fatalities, 0 AS injured, 'news' AS source_name, 'http://e/'||event_id AS page FROM events WHERE event_id % 10 > 0"
)


@check("u2_eswd_events", _ESWD_SQL)
def u2_eswd(spark, sf):
    from hazardspark.sources import catalogues

    e = catalog.eswd_events(catalogues.eswd(_eswd_rows(spark, sf)))
    return e.select("type", "subtype", "date", "year", "month", "day", "hour", "latitude", "longitude", "district", "municipality", "parish", "fatalities", "injured", "source_name", "page")


def _report_rows(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.lit("Flood").alias(" Type"), F.col("o_orderpriority").alias("subtype"), F.when(k % 2 == 0, F.date_format("o_orderdate", "d/M/yyyy")).alias("DATE"),
        F.year("o_orderdate").alias("Year"), F.month("o_orderdate").alias("month"), (F.dayofmonth("o_orderdate") + F.when(k % 10 == 1, 31).otherwise(0)).alias("day"),
        F.lit("noite").alias("hour"), F.when(k % 3 > 0, F.col("o_totalprice") / 10000).alias("latitude"), F.when(k % 3 > 0, F.lit(-8.5)).alias("longitude"),
        (k % 4).cast("string").alias("georef"), F.lit("D").alias("district"), F.concat(F.lit("M"), F.col("o_custkey")).alias("municipali"), F.col("o_orderstatus").alias("parish"),
        F.lit(None).cast("string").alias("dicofreg"), F.when(k % 3 == 0, "7.9").otherwise("x").alias("fatalities"), F.lit(1).alias("injured"), F.lit("jornal").alias("source"),
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("sourcedate"), F.lit("press").alias("sourcetype"), F.concat(F.lit("p"), k.cast("string")).alias("page"),
    )


_REPORT_SQL = (
    "SELECT 'Flood' AS type, o_orderpriority AS subtype, CASE WHEN o_orderkey % 10 = 1 THEN DATE '1900-01-01' ELSE o_orderdate::DATE END AS date, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, "
    "(day(o_orderdate)+CASE WHEN o_orderkey%10=1 THEN 31 ELSE 0 END)::INTEGER AS day, 'noite' AS hour, round(CASE WHEN o_orderkey%3>0 THEN o_totalprice/10000 ELSE 0.0 END,6) AS latitude, CASE WHEN o_orderkey%3>0 THEN -8.5::DOUBLE ELSE 0.0::DOUBLE END AS longitude, "
    "(CASE WHEN o_orderkey%4=0 THEN 1 ELSE o_orderkey%4 END)::INTEGER AS georef_class, 'M'||o_custkey AS municipality, CASE WHEN o_orderkey%3=0 THEN 7 ELSE 0 END AS fatalities, o_orderdate::DATE AS source_date, 'p'||o_orderkey AS page FROM orders"
)


@check("u2_report_events", _REPORT_SQL)
def u2_reports(spark, sf):
    from hazardspark.sources import catalogues

    r = catalog.report_events(catalogues.tabular(_report_rows(spark, sf)))
    return r.select("type", "subtype", "date", "year", "month", "day", "hour", F.round("latitude", 6).alias("latitude"), "longitude", "georef_class", "municipality", "fatalities", "source_date", "page")


_FEATURE_SQL = (
    "SELECT 'Cheia' AS type, coalesce(CASE WHEN event_id%5<>4 THEN ts END::DATE, DATE '1900-01-01') AS date, coalesce(year(CASE WHEN event_id%5<>4 THEN ts END),0)::INTEGER AS year, coalesce(strftime(CASE WHEN event_id%5<>4 THEN ts END,'%H:%M'),'') AS hour, "
    "CASE WHEN event_id%3>0 THEN value ELSE 0.0 END AS latitude, CASE WHEN event_id%3>0 THEN -value ELSE 0.0 END AS longitude, 'C'||(event_id%50) AS district, 'C'||(event_id%50) AS municipality, 'F'||user_id AS parish, ts::DATE AS source_date FROM events"
)


def _feature_rows(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id")
    ms = F.floor(F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)") / 1000).cast("bigint")
    return e.select(
        F.lit("Cheia").alias("Natureza"), F.when(k % 5 < 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("DataInicioOcorrencia"),
        F.when((k % 5 == 2) | (k % 5 == 3), ms).alias("DataOcorrencia"), ms.alias("DataDosDados"), F.when(k % 3 > 0, F.col("value")).alias("Latitude"),
        F.when(k % 3 > 0, -F.col("value")).alias("Longitude"), F.concat(F.lit("C"), (k % 50).cast("string")).alias("Concelho"), F.concat(F.lit("F"), "user_id").alias("Freguesia"),
    )


@check("u2_feature_events", _FEATURE_SQL)
def u2_features(spark, sf):
    e = catalog.feature_events(_feature_rows(spark, sf))
    return e.select("type", "date", "year", "hour", "latitude", "longitude", "district", "municipality", "parish", "source_date")


def _all_catalogues(spark, sf):
    from hazardspark.sources import catalogues

    known = fr.renamed(fr.gazetteer(spark, sf).withColumn("municipality", F.col("district")), "municipality", F.col("n_nationkey") >= 20).select("district", "municipality").distinct()
    return catalog.union_events(
        catalog.emdat_events(_catalogue(spark, sf), known, fr.centroids(spark, sf)),
        catalog.eswd_events(catalogues.eswd(_eswd_rows(spark, sf))),
        catalog.feature_events(_feature_rows(spark, sf)),
        catalog.report_events(catalogues.tabular(_report_rows(spark, sf))),
    )


@check(
    "u2_union_of_catalogues",
    f"{_EMDAT_SQL} SELECT 'emdat' AS catalogue, count(*) AS n, sum({_share_sql('deaths')})::BIGINT AS fatalities FROM x UNION ALL SELECT 'eswd', count(*), sum(fatalities)::BIGINT FROM ({_ESWD_SQL}) "
    f"UNION ALL SELECT 'features', count(*), 0::BIGINT FROM ({_FEATURE_SQL}) UNION ALL SELECT 'reports', count(*), sum(fatalities)::BIGINT FROM ({_REPORT_SQL})",
)
def u2(spark, sf):
    return _all_catalogues(spark, sf).groupBy("catalogue").agg(F.count(F.lit(1)).alias("n"), F.sum("fatalities").alias("fatalities"))


@check(
    "u2_rejects",
    "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'n/a' ELSE '38.5' END AS latitude, CASE WHEN c_custkey % 7 = 0 THEN 'rejected' ELSE 'mapped' END AS outcome FROM customer",
)
def u2_rejects(spark, sf):
    """Reports with an unreadable coordinate are set aside and take no others with them."""
    reports = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 7 == 0, "n/a").otherwise("38.5").alias("latitude"), F.lit("-9.1").alias("longitude")
    )
    good, bad = catalog.report_quarantine(reports)
    return good.withColumn("outcome", F.lit("mapped")).unionByName(bad.withColumn("outcome", F.lit("rejected"))).drop("longitude")


@check(
    "k8_star_fan_out",
    f"SELECT count(*) AS disasters, count(*) AS ids, count(latitude) AS locations, count(*) AS impacts, count(*) AS sources, sum(fatalities)::BIGINT AS fatalities, round(sum(latitude),2) AS lat_sum FROM ({_ESWD_SQL} UNION ALL {_ESWD_SQL})",
)
def k8(spark, sf):
    """Doubled catalogue to four tables and back through the ids."""
    from hazardspark.sources import catalogues

    wide = catalog.eswd_events(catalogues.eswd(_eswd_rows(spark, sf)))
    star = catalog.fan_out(catalog.with_event_id(wide.unionByName(wide)))
    n = F.count(F.lit(1))
    joined = (
        star.disasters.join(star.location, "id", "left").join(star.human_impacts, "id")
        .join(star.information_sources.withColumnRenamed("disaster_id", "id"), "id")
    )
    return joined.agg(
        n.alias("disasters"), F.count_distinct("id").alias("ids"), F.count("latitude").alias("locations"), F.count("fatalities").alias("impacts"),
        F.count("source_name").alias("sources"), F.sum("fatalities").alias("fatalities"), F.round(F.sum("latitude"), 2).alias("lat_sum"),
    )


def _staging(spark, sf):
    used = ["seq", "page", "type", "subtype", "l_tax", "date", "hour", "district", "municipali", "parish", "DICOFREG", *VICTIMS, "source", "sourcedate", "sourcetype"]
    a = dedupe.keep_first(fr.articles(spark, sf).select(*used), ["page"], ["seq"])
    return a.select(
        F.col("page").alias("ID"), "type", "subtype", F.when(F.col("l_tax") > 0.07, "ontem").otherwise(F.col("date")).alias("date"), "hour", F.lit(None).cast("string").alias("georef"), "district", "municipali", "parish",
        "DICOFREG", *VICTIMS, "source", "sourcedate", "sourcetype", "page",
    )


_STAGING_SQL = "st AS (SELECT * FROM art QUALIFY row_number() OVER (PARTITION BY page ORDER BY seq) = 1)"


def _old_events(spark, sf):
    # The ids that the merge reads, so that both read the same shuffled articles.
    s = _staging(spark, sf).where((F.col("fatalities") > 25) & F.col("ID").isNotNull())
    old = publication.events_of_staging(s, _stamp())
    return old.withColumns({"type": F.lit("Other"), "fatalities": F.lit(1), "hour": F.lit("00:01"), "latitude": F.lit(40.5), "longitude": F.lit(-8.5), "georef_class": F.lit("concelho")})


@check(
    "publication_main_table",
    fr.texts(fr.ART, fr.CEN) + f", {_STAGING_SQL}, {_LEVELS_SQL}, ok AS (SELECT * FROM st WHERE l_tax <= 0.07), "
    f"ev AS (SELECT a.page AS id, a.type, a.day_date, CASE WHEN fatalities > 25 THEN '00:01' ELSE hour END AS hour, fatalities, injured, fatalities > 25 AS old, {_LOCATE_SQL} "
    "FROM ok a LEFT JOIN lf ON lf.k = lower(a.parish) LEFT JOIN lc ON lc.k = lower(a.municipali) LEFT JOIN ld ON ld.k = lower(a.district)) "
    "SELECT id, type, strftime(day_date,'%Y/%m/%d') AS date, hour, fatalities, injured, CASE WHEN old THEN 40.5::DOUBLE ELSE p.lat END AS latitude, CASE WHEN old THEN -8.5::DOUBLE ELSE p.lon END AS longitude, CASE WHEN old THEN 'concelho' ELSE lev END AS georef_class, "
    "'POINT('||CASE WHEN old THEN -8.5::DOUBLE ELSE p.lon END||' '||CASE WHEN old THEN 40.5::DOUBLE ELSE p.lat END||')' AS location_geom FROM ev WHERE old OR p IS NOT NULL",
)
def publication_main(spark, sf):
    """Staging -> events (some exist) -> centroids -> geometry -> main table."""
    from hazardspark.functions import dates as D

    empty = spark.createDataFrame([], EVENT)
    out = publication.publish(_staging(spark, sf), _old_events(spark, sf), empty, fr.centroids(spark, sf), _stamp())
    return out.main.select("id", "type", D.ymd_text(F.col("date")).alias("date"), "hour", "fatalities", "injured", "latitude", "longitude", "georef_class", "location_geom")


@check(
    "k6_typed_staging",
    ART + "SELECT ID, date, fatalities, relevance_score, DICOFREG, district FROM (SELECT ID, CASE l_linenumber%3 WHEN 0 THEN date WHEN 1 THEN strftime(day_date,'%d/%m/%Y') END AS date, fatalities, (l_linenumber%4)::FLOAT AS relevance_score, DICOFREG, CASE WHEN l_linenumber=4 THEN '' ELSE district END AS district FROM art) WHERE date IS NOT NULL",
)
def k6(spark, sf):
    a = fr.articles(spark, sf)
    k = F.col("l_linenumber")
    raw = a.select(
        F.col("ID").alias("original_id"), F.when(k % 3 == 0, F.col("date")).when(k % 3 == 1, F.date_format("day_date", "yyyy-MM-dd")).otherwise("?").alias("date"),
        F.col("fatalities").cast("string").alias("fatalities"), (k % 4).cast("string").alias("relevance_score"), "DICOFREG", F.when(k == 4, "nan").otherwise(F.col("district")).alias("district"),
    )
    return sink_tables.staging_frame(raw, _stamp()).select("ID", "date", "fatalities", "relevance_score", "DICOFREG", "district")


_NEWS_KIND, _NEWS_SUB = hazard_sql("norm")


@check(
    "news_articles_from_raw",
    ART + f", r AS (SELECT *, {fr.norm_sql('title')} AS norm FROM art WHERE NOT ({fr.any_sql('lower(title)', vocab.OFF_TOPIC)} AND NOT {fr.any_sql('lower(title)', vocab.ON_TOPIC)})), "
    f"v AS (SELECT ID, {title_counts_sql('lower(title)')} FROM r), "
    "pc AS (SELECT n_name||' '||c_mktsegment AS m, max(lpad(c_custkey::VARCHAR,6,'0')) AS code FROM customer JOIN nation ON c_nationkey=n_nationkey GROUP BY 1) "
    f"SELECT r.ID, title, {_NEWS_KIND} AS type, {_NEWS_SUB} AS subtype, date, year, month, day, hour, municipali AS georef, district, municipali, municipali AS parish, code AS DICOFREG, "
    "regexp_replace(split_part(outlet,'.',1),'[^a-z]','','g') AS source, '2001-08-01' AS sourcedate, 'web' AS sourcetype, link AS page, "
    + ", ".join(f"v.{v}" for v in VICTIMS) + " FROM r JOIN v ON v.ID = r.ID JOIN pc ON pc.m = municipali",
)
def news_articles(spark, sf):
    """Raw articles to article rows through the news plan."""
    raw = fr.published(fr.articles(spark, sf)).select("ID", "keyword", "localidade", "title", "link", "published", F.lit("2001-08-01").alias("collection_date"))
    g = fr.gazetteer(spark, sf)
    places = g.groupBy(F.lower("municipality").alias("place_key")).agg(F.max("district").alias("district"), F.max("municipality").alias("municipality"))
    codes = gazetteer.parish_codes(g, "municipality", "code", ["code"])
    return news.process(raw, places, codes, "2001-08-01")
