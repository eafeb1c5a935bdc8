"""Queries over row predicates and the filter cascade."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardspark import vocab
from hazardspark.checks import frames as fr
from hazardspark.checks.base import check, table
from hazardspark.checks.extract_checks import ART, CATEGORIES, GATE, SCORE
from hazardspark.checks.text_checks import _DATES, _MESSY_SQL, _dates, _messy
from hazardspark.functions import extract as X
from hazardspark.functions import text as T
from hazardspark.operators import filters
from hazardspark.schemas import ARTICLE, VICTIMS

AS_OF = "2001-08-01"


@check(
    "f1_required_fields",
    "SELECT page_id FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE 'x' END AS t, url FROM pages) WHERE length(trim(t)) > 0 AND length(trim(url)) > 0",
)
def f1(spark, sf):
    k = F.col("page_id") % 4
    p = table(spark, sf, "pages").select(
        "page_id", F.col("page_id").cast("string").alias("ID"), F.col("url").alias("link"),
        F.when(k == 0, " ").when(k == 1, F.lit(None)).otherwise("x").alias("title"),
    )
    return filters.has_required(p).select("page_id")


_OFF = f"({fr.any_sql('lower(title)', vocab.OFF_TOPIC)} AND NOT {fr.any_sql('lower(title)', vocab.ON_TOPIC)})"


@check("f2_off_topic", ART + f"SELECT seq FROM art WHERE NOT {_OFF}")
def f2(spark, sf):
    return fr.articles(spark, sf).where(~filters.is_off_topic(F.col("title"))).select("seq")


_FOREIGN = (
    f"({fr.any_sql('lower(title)', vocab.FOREIGN_COUNTRIES)} OR {fr.any_sql('lower(page)', vocab.FOREIGN_COUNTRIES)} OR {fr.any_sql('lower(page)', vocab.FOREIGN_URL_HINTS)})"
)


@check("f3_foreign_news", ART + f"SELECT seq, {_FOREIGN} AS is_foreign FROM art")
def f3(spark, sf):
    return fr.articles(spark, sf).select("seq", filters.is_foreign_news(F.col("title"), F.col("page")).alias("is_foreign"))


_TITLED = f"upper(left(district,1))||lower(substr(district,2))"
_PLACE = f"({_TITLED} IN (SELECT district FROM vd) AND (parish = '' OR parish IN (SELECT parish FROM vp)))"
ARTV = fr.texts(fr.ART, fr.VALID)


@check("f4_national_articles", ARTV + f"SELECT seq FROM art WHERE {_PLACE} AND NOT {fr.any_sql('lower(page)', vocab.NATIONAL_EXCLUDED)}")
def f4(spark, sf):
    a = fr.articles(spark, sf)
    return filters.national_articles(a, fr.valid_districts(spark, sf), fr.valid_parishes(spark, sf)).select("seq")


_HOME = f"({fr.any_sql('lower(page)', vocab.HOME_URL_HINTS)} OR NOT {fr.any_sql('lower(page)', vocab.FOREIGN_URL_WORDS)})"
_GEO = f"({_PLACE} AND {_HOME})"


@check("f5_geographic_filter", ARTV + f"SELECT seq FROM art WHERE {_GEO}")
def f5(spark, sf):
    a = fr.articles(spark, sf)
    return filters.geographic(a, fr.valid_districts(spark, sf), fr.valid_parishes(spark, sf)).select("seq")


def quality_sql(u: str, title: str) -> str:
    return (
        f"((length({u}) > 20 AND right({u},1) <> '/')::INTEGER + (length({title}) > 10)::INTEGER + (NOT {fr.any_sql(u, vocab.SOCIAL_MEDIA)})::INTEGER "
        f"+ (NOT {fr.any_sql(u, vocab.FORUM_WORDS)})::INTEGER + {fr.any_sql(u, vocab.KNOWN_OUTLETS)}::INTEGER)"
    )


@check(
    "f6_quality",
    ART + f"SELECT k, {quality_sql('u', 't')} AS points, {quality_sql('u', 't')} >= 3 AS passes FROM (SELECT seq AS k, lower(page) AS u, title AS t FROM art "
    "UNION ALL SELECT 'p'||page_id, lower(url), split_part(url,'/',-1) FROM pages)",
)
def f6(spark, sf):
    a = fr.articles(spark, sf).select(F.col("seq").alias("k"), F.col("page").alias("u"), F.col("title").alias("t"))
    p = table(spark, sf, "pages").select(
        F.concat(F.lit("p"), "page_id").alias("k"), F.col("url").alias("u"), F.substring_index("url", "/", -1).alias("t")
    )
    both = a.unionByName(p)
    return both.select(
        "k", filters.quality_points(F.col("u"), F.col("t")).alias("points"), filters.is_quality(F.col("u"), F.col("t")).alias("passes")
    )


@check("f7_keyword_gate", ART + f"SELECT seq FROM (SELECT seq, lower(page) AS g FROM art) WHERE {GATE}")
def f7(spark, sf):
    return fr.articles(spark, sf).where(X.keyword_gate_passes(F.col("page"))).select("seq")


@check(
    "f8_recent",
    f"SELECT o_orderkey FROM {_DATES} WHERE o_orderkey % 9 NOT IN (0, 1, 5) OR date_diff('day', d, DATE '{AS_OF}') - (CASE WHEN o_orderkey % 9 = 5 THEN 1 ELSE 0 END) BETWEEN 0 AND 365",
)
def f8(spark, sf):
    return _dates(spark, sf).where(filters.is_recent(F.col("s"), AS_OF)).select("o_orderkey")


_LI = (
    "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, (l_quantity*100)::INTEGER AS fatalities, (l_quantity*150*(l_linenumber-2))::INTEGER AS injured, "
    "CASE WHEN l_returnflag='R' THEN NULL ELSE 0 END AS evacuated, CASE WHEN l_linestatus='F' THEN -5 ELSE 0 END AS displaced, (l_linenumber*700)::INTEGER AS missing FROM lineitem "
    "UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, 0, -1, NULL, 0, CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END FROM lineitem)"
)


def _line_victims(spark, sf):
    l = table(spark, sf, "lineitem")
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    a = l.select(
        *key, (F.col("l_quantity") * 100).cast("int").alias("fatalities"),
        (F.col("l_quantity") * 150 * (F.col("l_linenumber") - 2)).cast("int").alias("injured"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(0).alias("evacuated"),
        F.when(F.col("l_linestatus") == "F", -5).otherwise(0).alias("displaced"), (F.col("l_linenumber") * 700).alias("missing"),
    )
    b = l.select(
        *key, F.lit(0).alias("fatalities"), F.lit(-1).alias("injured"), F.lit(None).cast("int").alias("evacuated"), F.lit(0).alias("displaced"),
        F.when(F.col("l_quantity") > 40, 1).otherwise(0).alias("missing"),
    )
    return a.unionByName(b)


_POS = [f"greatest(coalesce({v},0),0)" for v in VICTIMS]


@check(
    "f9_plausible_victims",
    f"SELECT l_orderkey, l_linenumber, l_partkey, {', '.join(VICTIMS)} FROM {_LI} WHERE greatest({','.join(_POS)}) <= 10000 AND {'+'.join(_POS)} BETWEEN 1 AND 10000",
)
def f9(spark, sf):
    return _line_victims(spark, sf).where(filters.victims_plausible()).select("l_orderkey", "l_linenumber", "l_partkey", *VICTIMS)


_SUM = "+".join(f"coalesce({v},0)" for v in VICTIMS)


@check(
    "f10_has_victims",
    f"SELECT greatest({','.join(f'coalesce({v},0)' for v in VICTIMS)}) > 0 AS has_any, ({_SUM}) > 0 AS has_sum, count(*) AS n FROM {_LI} GROUP BY ALL",
)
def f10(spark, sf):
    rows = _line_victims(spark, sf).select(filters.any_victims().alias("has_any"), (filters.victim_total() > 0).alias("has_sum"))
    return rows.groupBy("has_any", "has_sum").agg(F.count(F.lit(1)).alias("n"))


@check("f10_with_victims", f"SELECT o_orderkey FROM (SELECT o_orderkey, {_MESSY_SQL} AS s FROM orders) WHERE {fr.count_sql('s')} > 0")
def f10b(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", _messy().alias("fatalities"))
    return filters.with_victims(o).select("o_orderkey")


@check("f11_min_relevance", ART + f"SELECT seq, {SCORE} AS relevance_score FROM (SELECT seq, lower(page)||' '||lower(title) AS xt FROM art) WHERE {SCORE} >= 2")
def f11(spark, sf):
    a = fr.articles(spark, sf).select("seq", "page", "title")
    a = T.computed_once(a, relevance_score=X.relevance_score(X.relevance_text(F.col("page"), F.col("title"))))
    return a.where(F.col("relevance_score") >= vocab.MIN_RELEVANCE).select("seq", "relevance_score")


@check("f12_title_rule", "SELECT p_partkey FROM part WHERE length(p_name) >= 10")
def f12(spark, sf):
    return table(spark, sf, "part").where(filters.long_enough_title(F.col("p_name"))).select("p_partkey")


@check("f13_publication_window", ART + f"SELECT seq FROM art WHERE l_linenumber <> 3 AND day_date BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}'")
def f13(spark, sf):
    a = fr.published(fr.articles(spark, sf))
    p = F.when(F.col("l_linenumber") != 3, F.col("published"))
    return a.where(filters.in_publication_window(p, AS_OF, 30)).select("seq")


@check("f14_catalogue_rows", "SELECT p_partkey FROM part WHERE lower(p_brand) = 'brand#2' AND lower(p_type) = 'economy'")
def f14(spark, sf):
    return table(spark, sf, "part").where(filters.catalogue_rows(F.col("p_brand"), F.col("p_type"), ("brand#2", "economy"))).select("p_partkey")


@check(
    "f15_domain_filters",
    fr.texts(fr.DIS, fr.LOC) + f"SELECT id, {fr.capital_sql('type')} AS type, {fr.title_sql('trim(district)')} AS district FROM dis JOIN loc USING (id) "
    f"WHERE {fr.capital_sql('type')} IN ('Flood','Landslide') AND latitude IS NOT NULL AND longitude IS NOT NULL AND latitude <> -999 AND longitude <> -999 AND district <> ''",
)
def f15(spark, sf):
    from hazardspark.operators import report

    d = report.clean_disasters(fr.disasters(spark, sf)).select("id", "type")
    loc = report.clean_locations(fr.locations(spark, sf))
    return d.join(loc, "id").where(filters.named_district(F.col("district"))).select("id", "type", "district")


@check("f15_publishable", ART + "SELECT seq FROM art WHERE l_linenumber % 2 = 0 AND lower(type) <> 'fire' AND l_tax > 0.01")
def f15b(spark, sf):
    a = fr.articles(spark, sf)
    a = a.withColumns(
        {
            "latitude": F.when(F.col("l_linenumber") % 2 == 0, 39.5), "longitude": F.when(F.col("l_tax") > 0.01, -8.0),
            "type": F.when(F.col("type") == "Fire", "OTHER").otherwise(F.col("type")),
        }
    )
    return a.where(filters.publishable()).select("seq")


@check(
    "f16_empty_and_invalid_rows",
    f"SELECT s, count(*) AS n FROM (SELECT CASE o_orderkey % 9 WHEN 1 THEN s WHEN 6 THEN s WHEN 0 THEN strftime(d,'%d/%m/%Y') WHEN 2 THEN strftime(d,'%d/%m/%Y') "
    f"WHEN 3 THEN strftime(d,'%d/%m/%Y') END AS s FROM {_DATES}) WHERE s IS NOT NULL GROUP BY s",
)
def f16(spark, sf):
    rows = filters.drop_empty_rows(_dates(spark, sf).select("s"))
    return filters.drop_invalid_dates(rows, "s").groupBy("s").agg(F.count(F.lit(1)).alias("n"))


# --- cascade ---------------------------------------------------------------------------------

_RECENT = f"(date_diff('day', day_date, DATE '{AS_OF}') BETWEEN 0 AND 700)"
_PLAUS = f"(greatest({','.join(VICTIMS)}) <= 10000 AND {'+'.join(VICTIMS)} BETWEEN 1 AND 10000)"
_STAGES = [("geographic", _GEO), ("quality", f"{quality_sql('lower(page)', 'title')} >= 3"), ("keyword", GATE), ("temporal", _RECENT),
           ("victims", _PLAUS), ("relevance", f"{SCORE} >= 2")]
_CAS = ARTV + ", base AS (SELECT *, lower(page) AS g, lower(page)||' '||lower(title) AS xt FROM art), "
_DEDUPED = (
    f"kept AS (SELECT * FROM base WHERE {' AND '.join(f'({t})' for _, t in _STAGES)}), "
    "pages1 AS (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY page ORDER BY seq) = 1), "
    "uniq AS (SELECT * FROM pages1 QUALIFY row_number() OVER (PARTITION BY district, parish, date, fatalities, injured ORDER BY seq) = 1) "
)
MAX_AGE = 700


def _cascade_args(spark, sf):
    a = fr.articles(spark, sf).select("seq", *ARTICLE.fieldNames())
    return a, fr.valid_districts(spark, sf), fr.valid_parishes(spark, sf)


@check(
    "f17_filter_cascade",
    _CAS + _DEDUPED + f"SELECT seq, ID, page, date, district, parish, fatalities, injured, evacuated, displaced, missing, {SCORE} AS relevance_score, "
    f"{CATEGORIES} AS matched_categories, coalesce({fr.first_sql('g', vocab.STORM_NAMES)}, 'desconhecido') AS evento_nome FROM uniq",
)
def f17(spark, sf):
    a, d, p = _cascade_args(spark, sf)
    out = filters.cascade(a, d, p, AS_OF, ["seq"], MAX_AGE)
    return out.select(
        "seq", "ID", "page", "date", "district", "parish", *VICTIMS, "relevance_score",
        F.array_join("matched_categories", ",").alias("matched_categories"), "evento_nome",
    )


def _counts_sql() -> str:
    parts, tests = ["SELECT 0 AS stage_no, 'loaded' AS stage, count(*) AS n_rows FROM base"], []
    for i, (name, test) in enumerate(_STAGES, 1):
        tests.append(f"({test})")
        parts.append(f"SELECT {i}, '{name}', count(*) FROM base WHERE {' AND '.join(tests)}")
    parts.append(f"SELECT {len(_STAGES) + 1}, 'page_dedupe', count(*) FROM pages1")
    parts.append(f"SELECT {len(_STAGES) + 2}, 'content_dedupe', count(*) FROM uniq")
    return " UNION ALL ".join(parts)


@check("f17_cascade_counts", _CAS + _DEDUPED + _counts_sql())
def f17c(spark, sf):
    a, d, p = _cascade_args(spark, sf)
    return filters.cascade_counts(a, d, p, AS_OF, ["seq"], MAX_AGE)


@check(
    "f18_route",
    ART + "SELECT CASE WHEN l_linenumber = 6 AND l_tax < 0.02 THEN 'error' WHEN type NOT IN ('Fire','Storm') OR (label='injured' AND n > 0) THEN 'relevant' ELSE 'irrelevant' END AS route, count(*) AS n FROM art GROUP BY 1",
)
def f18(spark, sf):
    a = fr.articles(spark, sf)
    kind = F.when((F.col("l_linenumber") == 6) & (F.col("l_tax") < 0.02), F.lit(None)).when(F.col("type").isin("Fire", "Storm"), "Other").otherwise(F.col("type"))
    a = a.withColumns({"type": kind, **{v: F.lit(0) for v in VICTIMS if v != "injured"}})
    return a.groupBy(filters.route(F.col("type")).alias("route")).agg(F.count(F.lit(1)).alias("n"))
