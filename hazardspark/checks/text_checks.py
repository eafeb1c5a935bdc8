"""Queries over the text and date functions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardspark import vocab
from hazardspark.checks import frames as fr
from hazardspark.checks.base import check, documents, table
from hazardspark.functions import dates as D
from hazardspark.functions import html as H
from hazardspark.functions import text as T
from hazardspark.operators import filters, relevance


def _text_md5(col: str):
    return F.md5(F.col(col).cast("binary"))


@check(
    "t1_normalize",
    f"SELECT doc_id, md5(x) AS norm_md5, length(x)::INTEGER AS norm_len FROM "
    f"(SELECT doc_id, {fr.norm_sql('text')} AS x FROM documents)",
)
def t1(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", T.normalize(F.col("text")).alias("x"))
    return docs.select("doc_id", _text_md5("x").alias("norm_md5"), F.length("x").alias("norm_len"))


_WORDS = list(vocab.NUMBER_WORDS) + ["dezassete", "umas", "seis-"]


def _words_sql(x: str) -> str:
    by_value: dict[int, list[str]] = {}
    for word, value in vocab.NUMBER_WORDS.items():
        by_value.setdefault(value, []).append(word)
    for value, names in by_value.items():
        x = f"regexp_replace({x}, '\\b(?:{'|'.join(names)})\\b', '{value}', 'g')"
    return x


_WORD_SQL = f"({_WORDS!r})[(p_size % {len(_WORDS)}) + 1]"


@check(
    "t2_words_to_numbers",
    f"SELECT p_partkey, {_words_sql('s')} AS words FROM (SELECT p_partkey, "
    f"{_WORD_SQL} || ' ' || p_name || ' ' || {_WORD_SQL.replace('p_size', '(p_partkey)')} AS s FROM part)",
)
def t2(spark, sf):
    names = F.array(*[F.lit(w) for w in _WORDS])
    word = lambda c: F.get(names, (c % len(_WORDS)).cast("int"))
    p = table(spark, sf, "part").select(
        "p_partkey", F.concat_ws(" ", word(F.col("p_size")), "p_name", word(F.col("p_partkey"))).alias("s")
    )
    return p.select("p_partkey", T.words_to_numbers(F.col("s")).alias("words"))


@check(
    "t3_clean_for_csv",
    f"SELECT doc_id, md5(x) AS clean_md5 FROM (SELECT doc_id, trim(regexp_replace(replace(text,'\"',''''), "
    f"'{fr.UNI_SPACE}+', ' ', 'g'), ' ') AS x FROM documents)",
)
def t3(spark, sf):
    docs = documents(spark, sf).select("doc_id", T.clean_for_csv(F.col("text")).alias("x"))
    return docs.select("doc_id", _text_md5("x").alias("clean_md5"))


@check(
    "t4_normalize_url",
    r"SELECT page_id, regexp_replace(url, '[?#].*$', '') AS clean_url, split_part(url,'?',1) AS base_url FROM pages",
)
def t4(spark, sf):
    p = table(spark, sf, "pages")
    return p.select(
        "page_id", T.normalize_url(F.col("url")).alias("clean_url"), T.base_url(F.col("url")).alias("base_url")
    )


@check(
    "t5_ids",
    r"SELECT page_id, md5(regexp_replace(url, '[?#].*$', '')) AS url_id, left(md5(url||html),16) AS fallback_id,"
    r" md5(lower(html)) AS title_hash FROM pages",
)
def t5(spark, sf):
    p = table(spark, sf, "pages").withColumn("t", F.col("html"))
    return p.select(
        "page_id", T.url_id(F.col("url")).alias("url_id"),
        T.fallback_id(F.col("url"), F.col("t")).alias("fallback_id"), T.title_hash(F.col("t")).alias("title_hash"),
    )


_HOST = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)"
_PATH = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"


@check(
    "t6_source_name",
    f"SELECT page_id, lower(regexp_replace(split_part(replace({_HOST},'www.',''),'.',1),'[^a-zA-Z]','','g')) AS source FROM pages",
)
def t6(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.source_name(F.col("url")).alias("source"))


_SLUG = f"regexp_replace(split_part({_PATH},'/',-1), ';.*$', '')"


@check(
    "t7_title_from_url",
    f"SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace({_SLUG},'[-_]+',' ','g'),'\\.(html|htm|php)$',''),"
    f"'[^\\p{{L}}\\p{{N}}_\\s]','','g')) AS slug_title FROM (SELECT page_id, url FROM pages UNION ALL SELECT page_id + 1000000000, "
    f"rtrim(regexp_replace(url,'[?#].*$',''),'/')||'-grande_inundacao--lisboa.html' FROM pages)",
)
def t7(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    slugged = p.select(
        (F.col("page_id") + 1000000000).alias("page_id"),
        F.concat(F.rtrim(T.normalize_url(F.col("url")), F.lit("/")), F.lit("-grande_inundacao--lisboa.html")).alias("url"),
    )
    return p.unionByName(slugged).select("page_id", T.title_from_url(F.col("url")).alias("slug_title"))


_BOIL = fr.any_sql(fr.norm_sql("y"), [p.lower() for p in vocab.BOILERPLATE])
_LINES = r"regexp_split_to_array(x, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]')"


@check(
    "t8_strip_boilerplate",
    f"SELECT doc_id, md5({fr.strip_sql(f'array_to_string(list_filter({_LINES}, lambda y: NOT {_BOIL}), chr(10))')}) AS kept_md5 "
    f"FROM (SELECT doc_id, {fr.strip_sql('text')} AS x FROM "
    "(SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || chr(10) || 'Última hora: Política de Privacidade' || chr(10) || 'fim' ELSE text END AS text FROM documents))",
)
def t8(spark, sf):
    docs = documents(spark, sf)
    noisy = F.concat("text", F.lit("\nÚltima hora: Política de Privacidade\nfim"))
    docs = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, noisy).otherwise(F.col("text")).alias("text"))
    return docs.select("doc_id", T.strip_boilerplate(F.col("text")).alias("x")).select(
        "doc_id", _text_md5("x").alias("kept_md5")
    )


@check(
    "t9_title_from_text",
    f"SELECT doc_id, coalesce(list_filter(list_transform({_LINES}, lambda y: {fr.strip_sql('y')}), "
    f"lambda y: length(y) > 15 AND length(y) < 120)[1], '') AS title FROM (SELECT doc_id, text AS x FROM documents)",
)
def t9(spark, sf):
    return documents(spark, sf).select("doc_id", T.title_from_text(F.col("text")).alias("title"))


_T10 = (
    "CASE event_id % 6 WHEN 0 THEN 'Cheia às '||hour(ts)||'h'||minute(ts)||' em '||event_type WHEN 1 THEN 'pelas '||hour(ts)||'H, '||event_type "
    "WHEN 2 THEN 'Durante a Madrugada '||event_type WHEN 3 THEN 'ontem de manhã '||event_type WHEN 4 THEN 'Noite e tarde '||event_type ELSE event_type END"
)


@check(
    "t10_event_hour",
    f"SELECT event_id, coalesce(nullif(regexp_extract(lower(s), '[0-9]{{1,2}}h(?:[0-9]{{1,2}})?'),''), "
    f"{fr.first_sql('lower(s)', vocab.DAY_PERIODS)}) AS event_hour FROM (SELECT event_id, {_T10} AS s FROM events)",
)
def t10(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id") % 6
    h, m = F.hour("ts").cast("string"), F.minute("ts").cast("string")
    s = (
        F.when(k == 0, F.concat(F.lit("Cheia às "), h, F.lit("h"), m, F.lit(" em "), "event_type"))
        .when(k == 1, F.concat(F.lit("pelas "), h, F.lit("H, "), "event_type"))
        .when(k == 2, F.concat(F.lit("Durante a Madrugada "), "event_type"))
        .when(k == 3, F.concat(F.lit("ontem de manhã "), "event_type"))
        .when(k == 4, F.concat(F.lit("Noite e tarde "), "event_type"))
        .otherwise(F.col("event_type"))
    )
    return e.select("event_id", T.event_hour(s).alias("event_hour"))


# Messy counts built from the order key.
_MESSY_SQL = (
    "CASE o_orderkey % 11 WHEN 0 THEN ' 12.7 ' WHEN 1 THEN 'nan' WHEN 2 THEN '1e12' WHEN 3 THEN NULL WHEN 4 THEN '' "
    "WHEN 5 THEN '-5.9' WHEN 6 THEN 'abc' WHEN 7 THEN '12d' WHEN 8 THEN 'inf' WHEN 9 THEN 'None' ELSE o_orderkey::VARCHAR||'.25' END"
)


def _messy():
    k = F.col("o_orderkey") % 11
    values = [" 12.7 ", "nan", "1e12", None, "", "-5.9", "abc", "12d", "inf", "None"]
    out = F.when(k == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        out = out.when(k == i, F.lit(v).cast("string"))
    return out.otherwise(F.concat(F.col("o_orderkey").cast("string"), F.lit(".25")))


@check(
    "t11_safe_values",
    f"SELECT o_orderkey, {fr.safe_int_sql('s')} AS safe_int, left(coalesce(s,'')||repeat(o_orderpriority,12), 100) AS safe_str, coalesce(s,'')||repeat(o_orderpriority,12) AS whole_str "
    f"FROM (SELECT o_orderkey, o_orderpriority, {_MESSY_SQL} AS s FROM orders)",
)
def t11(spark, sf):
    o = table(spark, sf, "orders").withColumn("s", _messy())
    long = F.concat(F.coalesce("s", F.lit("")), F.repeat("o_orderpriority", 12))
    return o.select("o_orderkey", T.safe_int(F.col("s")).alias("safe_int"), T.safe_str(long, 100).alias("safe_str"), T.safe_str(long).alias("whole_str"))


@check(
    "t12_wkt_point",
    fr.texts(fr.LOC) + "SELECT id, 'POINT('||longitude||' '||latitude||')' AS wkt FROM loc",
)
def t12(spark, sf):
    return fr.locations(spark, sf).select("id", T.wkt_point(F.col("latitude"), F.col("longitude")).alias("wkt"))


_ALIAS = {"Nation_3": "Terceira", "Nation_7": "Sétima", "Nation_21": "Terceira"}


@check(
    "t13_canonical_names",
    fr.texts(fr.GAZ) + f"SELECT code, {fr.capital_sql('municipality')} AS capitalised, {fr.title_sql('x')} AS titled, "
    f"CASE d {' '.join(f'WHEN {k!r} THEN {v!r}' for k, v in _ALIAS.items())} ELSE d END AS district FROM "
    f"(SELECT *, lower(district)||'-a-'||lower(parish) AS x, {fr.title_sql('district')} AS d FROM gaz)",
)
def t13(spark, sf):
    g = fr.gazetteer(spark, sf)
    return g.select(
        "code", T.capitalize(F.col("municipality")).alias("capitalised"),
        T.title_case(F.concat(F.lower("district"), F.lit("-a-"), F.lower("parish"))).alias("titled"),
        T.canonical_district(F.concat(F.lit(" "), "district", F.lit(" ")), _ALIAS).alias("district"),
    )


@check(
    "t14_null_tokens",
    f"SELECT o_orderkey, CASE WHEN s IS NULL OR s IN ('nan','None') THEN '' ELSE s END AS token FROM (SELECT o_orderkey, {_MESSY_SQL} AS s FROM orders)",
)
def t14(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", T.clean_token(_messy()).alias("token"))


@check(
    "t15_numeric_coercion",
    f"SELECT o_orderkey, {fr.count_sql('s')} AS fatalities, 0 AS injured FROM (SELECT o_orderkey, {_MESSY_SQL} AS s FROM orders)",
)
def t15(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _messy().alias("fatalities"))
    return filters.with_counts(o, ["fatalities", "injured"])


@check(
    "t16_relevance_text",
    f"SELECT page_id, CASE WHEN trim(x) = '' THEN 'no content' ELSE x END AS model_text FROM (SELECT page_id, concat_ws(' ', "
    f"CASE WHEN page_id % 4 <> 0 THEN 'Cheia em '||page_id END, replace({_HOST},'www.',''), html) AS x FROM pages)",
)
def t16(spark, sf):
    p = table(spark, sf, "pages").select(
        "page_id", F.when(F.col("page_id") % 4 != 0, F.concat(F.lit("Cheia em "), F.col("page_id").cast("string"))).alias("title"),
        F.col("url").alias("link"), F.col("html").alias("description"),
    )
    return relevance.with_model_text(p).select("page_id", "model_text")


@check(
    "t17_optional_column",
    "SELECT c_custkey, c_name AS name, CAST(NULL AS VARCHAR) AS parish, CAST(NULL AS DOUBLE) AS latitude FROM customer",
)
def t17(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        "c_custkey", filters.column_or_null(c, "c_name").alias("name"),
        filters.column_or_null(c, "parish").alias("parish"), filters.column_or_null(c, "latitude", "double").alias("latitude"),
    )


@check("t18_article_text")
def t18(spark, sf):
    p = H.bounded_pages(table(spark, sf, "pages"))
    return p.select("page_id", H.article_text("html").alias("text"), H.article_text_short("html").alias("short_text"))


_DOC_TERMS = ["tion", "über", "que los", "c++ (", "not there"]


@check(
    "t19_contains_any",
    f"SELECT doc_id, {fr.any_sql('text', _DOC_TERMS)} AS any_hit, ({' + '.join(f'contains(text, {t!r})::INTEGER' for t in _DOC_TERMS)}) AS n_hits FROM documents",
)
def t19(spark, sf):
    x = F.col("text")
    return documents(spark, sf).select(
        "doc_id", T.contains_any(x, _DOC_TERMS).alias("any_hit"), T.count_contained(x, _DOC_TERMS).alias("n_hits")
    )


# --- dates -----------------------------------------------------------------------------------

_DATE_SQL = (
    "CASE o_orderkey % 9 WHEN 0 THEN strftime(d,'%Y-%m-%d') WHEN 1 THEN day(d)||'/'||month(d)||'/'||year(d) "
    "WHEN 2 THEN strftime(d,'%d-%m-%Y') WHEN 3 THEN strftime(d,'%Y/%m/%d') WHEN 4 THEN strftime(d,'%d.%m.%Y') "
    "WHEN 5 THEN strftime(d,'%Y-%m-%d')||' 10:20:30' WHEN 6 THEN '31/02/'||year(d) WHEN 7 THEN 'ontem' ELSE NULL END"
)
_DATES = f"(SELECT o_orderkey, d, {_DATE_SQL} AS s FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders))"


def _dates(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    k, f = F.col("o_orderkey") % 9, lambda p: F.date_format("d", p)
    s = (
        F.when(k == 0, f("yyyy-MM-dd")).when(k == 1, f("d/M/yyyy")).when(k == 2, f("dd-MM-yyyy"))
        .when(k == 3, f("yyyy/MM/dd")).when(k == 4, f("dd.MM.yyyy"))
        .when(k == 5, F.concat(f("yyyy-MM-dd"), F.lit(" 10:20:30")))
        .when(k == 6, F.concat(F.lit("31/02/"), f("yyyy"))).when(k == 7, F.lit("ontem"))
    )
    return o.withColumn("s", s)


@check(
    "d1_parse_event_date",
    f"SELECT o_orderkey, dd AS date, year(dd)::INTEGER AS year, month(dd)::INTEGER AS month, day(dd)::INTEGER AS day FROM "
    f"(SELECT o_orderkey, CASE WHEN o_orderkey % 9 <= 5 THEN d END AS dd FROM {_DATES})",
)
def d1(spark, sf):
    return _dates(spark, sf).select("o_orderkey", D.parse_event_date(F.col("s")).alias("p")).select("o_orderkey", "p.*")


@check("d1_textual_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN o_orderdate::DATE END AS date FROM orders")
def d1b(spark, sf):
    """Dates with month names: Portuguese in full, English in full, Spanish by three letters; figures do not fit."""
    portuguese = "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro"
    english = "january february march april may june july august september october november december"
    spanish = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre"
    pick = lambda words: F.element_at(F.array(*[F.lit(w) for w in words.split()]), F.month("o_orderdate"))
    d, y, k = F.dayofmonth("o_orderdate"), F.year("o_orderdate"), F.col("o_orderkey") % 4
    text = (
        F.when(k == 0, F.concat_ws(" ", d, F.lit("de"), F.initcap(pick(portuguese)), F.lit("de"), y))
        .when(k == 1, F.concat(F.upper(pick(english)), F.lit("  "), d, F.lit(", "), y))
        .when(k == 2, F.concat(F.lit(" "), d, F.lit(" "), F.left(pick(spanish), F.lit(3)), F.lit(". "), y))
        .otherwise(F.date_format("o_orderdate", "dd.MM.yyyy"))
    )
    date = D.parse_text_date(F.col("s"), ["{d} de {M} de {y}", "{M} {d}, {y}", "{d} {M} {y}"])
    return table(spark, sf, "orders").select("o_orderkey", text.alias("s")).select("o_orderkey", date.alias("date"))


@check(
    "d2_published_date",
    "SELECT event_id, coalesce(strftime(t,'%d/%m/%Y'),'') AS date, year(t)::INTEGER AS year, month(t)::INTEGER AS month, "
    "day(t)::INTEGER AS day, coalesce(strftime(t,'%H:%M'),'') AS hour FROM (SELECT event_id, CASE WHEN event_id % 5 <> 4 THEN ts END AS t FROM events)",
)
def d2(spark, sf):
    e = table(spark, sf, "events")
    rss = F.concat(
        F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss "), F.when(F.col("event_id") % 2 == 0, "GMT").otherwise("+0000")
    )
    s = F.when(F.col("event_id") % 5 != 4, rss).otherwise("sem data")
    return e.select("event_id", D.format_published(s).alias("p")).select("event_id", "p.*")


@check(
    "d3_dmy_text",
    f"SELECT o_orderkey, CASE o_orderkey % 9 WHEN 1 THEN s WHEN 6 THEN s WHEN 0 THEN strftime(d,'%d/%m/%Y') WHEN 2 THEN strftime(d,'%d/%m/%Y') "
    f"WHEN 3 THEN strftime(d,'%d/%m/%Y') END AS dmy FROM {_DATES}",
)
def d3(spark, sf):
    return _dates(spark, sf).select("o_orderkey", D.to_dmy_text(F.col("s")).alias("dmy"))


@check(
    "d4_staging_date",
    f"SELECT o_orderkey, strftime(d,'%Y/%m/%d') AS ymd, year(d)::INTEGER AS year, month(d)::INTEGER AS month, day(d)::INTEGER AS day FROM {_DATES} WHERE o_orderkey % 9 = 1",
)
def d4(spark, sf):
    rows = _dates(spark, sf).withColumn("x", D.staging_date(F.col("s"))).where("x IS NOT NULL")
    return rows.select(
        "o_orderkey", D.ymd_text(F.col("x")).alias("ymd"), F.year("x").alias("year"), F.month("x").alias("month"),
        F.dayofmonth("x").alias("day"),
    )


@check(
    "d5_iso_or_millis",
    "SELECT event_id, t::DATE AS date, strftime(t,'%H:%M') AS hour FROM (SELECT event_id, CASE WHEN event_id % 7 <> 6 THEN ts END AS t FROM events)",
)
def d5(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id") % 7
    iso = F.when(k < 3, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).when(k == 3, "sem data")
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    ms = F.when((k >= 3) & (k < 6), F.floor(micros / 1000).cast("bigint"))
    t = D.iso_or_millis(iso, ms)
    return e.select("event_id", t.cast("date").alias("date"), F.date_format(t, "HH:mm").alias("hour"))


_PARTS_SQL = (
    "(SELECT o_orderkey, d, CASE o_orderkey % 4 WHEN 0 THEN 0 ELSE year(d) END AS y, CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN NULL WHEN 2 THEN 13 ELSE month(d) END AS m, "
    "CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 31 ELSE day(d) END AS dd FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders))"
)


def _parts_date_sql(y: str) -> str:
    return (
        f"try_cast(lpad(({y})::VARCHAR,4,'0')||'-'||lpad(coalesce(nullif(m,0),1)::VARCHAR,2,'0')||'-'||lpad(coalesce(nullif(dd,0),1)::VARCHAR,2,'0') AS DATE)"
    )


def _parts(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    k = F.col("o_orderkey")
    return o.withColumns(
        {
            "y": F.when(k % 4 == 0, 0).otherwise(F.year("d")),
            "m": F.when(k % 5 == 0, 0).when(k % 5 == 1, F.lit(None)).when(k % 5 == 2, 13).otherwise(F.month("d")),
            "dd": F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, 31).otherwise(F.dayofmonth("d")),
        }
    )


@check(
    "d6_day_first_date",
    f"SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN d END, {_parts_date_sql('coalesce(nullif(y,0),1900)')}, DATE '1900-01-01') AS date FROM {_PARTS_SQL}",
)
def d6(spark, sf):
    p = _parts(spark, sf)
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("d", "d/M/yyyy"))
    return p.select("o_orderkey", D.day_first_date(text, F.col("y"), F.col("m"), F.col("dd")).alias("date"))


@check(
    "d7_date_from_parts",
    f"SELECT o_orderkey, CASE WHEN y > 0 THEN {_parts_date_sql('y')} END AS date FROM {_PARTS_SQL}",
)
def d7(spark, sf):
    return _parts(spark, sf).select("o_orderkey", D.date_from_parts(F.col("y"), F.col("m"), F.col("dd")).alias("date"))


@check(
    "d8_hour_defaults",
    "SELECT event_id, coalesce(strftime(CASE WHEN event_id % 3 <> 0 THEN ts END,'%H:%M'),'08:00') AS hour, '00:00-00:00' AS catalogue_hour FROM events",
)
def d8(spark, sf):
    ts = F.when(F.col("event_id") % 3 != 0, F.col("ts"))
    return table(spark, sf, "events").select(
        "event_id", D.hour_text(ts, "08:00").alias("hour"), F.lit("00:00-00:00").alias("catalogue_hour")
    )


@check(
    "d9_month_start",
    "SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS month_start FROM orders",
)
def d9(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", D.month_start(F.year("o_orderdate"), F.month("o_orderdate")).alias("month_start"))


def _map_sql(x: str, values: dict) -> str:
    return f"(CASE {x} " + " ".join(f"WHEN {k} THEN {v}::DOUBLE" for k, v in values.items()) + " END)"


def calendar_sql(y: str = "year", m: str = "month") -> str:
    return (
        f"ceil({m}/3.0)::INTEGER AS trimestre, ({m} IN {tuple(vocab.RAINY_MONTHS)})::INTEGER AS estacao_chuvosa, "
        f"({m} IN {tuple(vocab.DRY_MONTHS)})::INTEGER AS estacao_seca, {_map_sql(m, vocab.FLOOD_RISK)} AS flood_seasonal_risk, "
        f"{_map_sql(m, vocab.LANDSLIDE_RISK)} AS landslide_seasonal_risk, ({y}-2000)::INTEGER AS anos_desde_2000, "
        f"round(sin(2*pi()*{m}/12),6)+0.0 AS sin_month, round(cos(2*pi()*{m}/12),6)+0.0 AS cos_month"
    )


@check(
    "d10_calendar_features",
    f"SELECT o_orderkey, {calendar_sql()} FROM (SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders)",
)
def d10(spark, sf):
    o = table(spark, sf, "orders")
    feats = D.calendar_features(F.year("o_orderdate"), F.month("o_orderdate"))
    feats = {k: F.round(c, 6) + F.lit(0.0) if k in ("sin_month", "cos_month") else c for k, c in feats.items()}
    return o.select("o_orderkey", *[c.alias(k) for k, c in feats.items()])


def fold(word: str) -> str:
    """Python statement of the normaliser, for SQL constants."""
    return unicodedata.normalize("NFKD", word.lower()).encode("ascii", "ignore").decode().strip()
