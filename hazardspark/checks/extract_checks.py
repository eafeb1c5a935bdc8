"""Queries over victim, hazard, event and score extraction, and the flagship query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardspark import vocab
from hazardspark.checks import frames as fr
from hazardspark.checks.base import check, documents, table
from hazardspark.checks.text_checks import _SLUG, _words_sql, fold
from hazardspark.functions import extract as X
from hazardspark.functions import text as T
from hazardspark.operators import dedupe, filters, geo, report
from hazardspark.schemas import VICTIMS
from hazardspark.sources import gazetteer

ART = fr.texts(fr.ART)


def body_counts_sql(prepared: str) -> str:
    """Five counts of a prepared (normalised, digits for words) SQL text."""
    cols = []
    for label, pattern in vocab.BODY_VICTIM_PATTERNS.items():
        n = f"try_cast(nullif(regexp_extract({prepared}, '{pattern}', 1), '') AS BIGINT)"
        cols.append(f"(CASE WHEN {n} < 1000 THEN {n} ELSE 0 END)::INTEGER AS {label}")
    return ", ".join(cols)


def title_counts_sql(low: str, words: bool = False) -> str:
    cols = []
    for label, patterns in vocab.TITLE_VICTIM_PATTERNS.items():
        found = " || ".join(f"regexp_extract_all({low}, '{p}', 1)" for p in patterns)
        n = f"list_max(list_transform({found}, lambda z: try_cast(z AS BIGINT)))"
        if words:
            names = "|".join(vocab.TITLE_NUMBER_WORDS)
            spelled = f"regexp_extract_all({low}, '({names})\\s*(?:{vocab.TITLE_WORD_NOUNS[label]})', 1)"
            value = " ".join(f"WHEN '{w}' THEN {v}" for w, v in vocab.TITLE_NUMBER_WORDS.items())
            n = f"greatest(coalesce({n},0), coalesce(list_max(list_transform({spelled}, lambda z: CASE z {value} END)),0))"
        cols.append(f"coalesce({n}, 0)::INTEGER AS {label}")
    return ", ".join(cols)


def hazard_sql(norm: str) -> tuple[str, str]:
    """CASE texts for type and subtype."""
    kind, sub = "CASE", "CASE"
    for name, spec in vocab.HAZARDS.items():
        hit = fr.any_sql(norm, spec["terms"])
        options = ", ".join(
            f"CASE WHEN {fr.any_sql(norm, words)} THEN '{label}' END" for label, words in spec["subtypes"].items()
        )
        kind += f" WHEN {hit} THEN '{name}'"
        sub += f" WHEN {hit} THEN coalesce({options}, {fr.first_sql(norm, spec['terms'])})"
    return kind + " ELSE 'Other' END", sub + " ELSE 'Other' END"


_KIND, _SUB = hazard_sql("norm")


@check(
    "flagship_monthly_victims",
    ART + f", p AS (SELECT seq, day_date, {fr.norm_sql('title')} AS norm FROM art), "
    f"x AS (SELECT seq, day_date, norm, {_KIND} AS type, {body_counts_sql(_words_sql('norm'))} FROM p), "
    "ok AS (SELECT * FROM x WHERE greatest(fatalities,injured,evacuated,displaced,missing) BETWEEN 1 AND 10000 "
    " QUALIFY row_number() OVER (PARTITION BY norm ORDER BY seq) = 1) "
    "SELECT year(day_date)::INTEGER AS year, month(day_date)::INTEGER AS month, type, count(*) AS ocorrencias, "
    + ", ".join(f"sum({v})::BIGINT AS {v}" for v in VICTIMS)
    + " FROM ok GROUP BY ALL",
)
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Headlines to victims and type, implausible and repeated ones out, counted per month."""
    rows = fr.articles(spark, sf).select("seq", "day_date", T.normalize(F.col("title")).alias("norm"))
    # Victims depend on the text alone, so repeats leave before a text is searched.
    rows = dedupe.keep_first(T.computed_once(rows, n=F.col("norm")).drop("norm"), ["n"], ["seq"])
    rows = X.with_victim_counts(rows, "n").where(filters.victims_plausible())
    rows = rows.withColumn("type", X.hazard_type(F.col("n"))["type"])
    return rows.groupBy(
        F.year("day_date").alias("year"), F.month("day_date").alias("month"), "type"
    ).agg(F.count(F.lit(1)).alias("ocorrencias"), *[F.sum(v).alias(v) for v in VICTIMS])


@check(
    "x1_victim_counts",
    ART + f"SELECT seq, {body_counts_sql('p')} FROM (SELECT seq, {_words_sql(fr.norm_sql('title'))} AS p FROM art)",
)
def x1(spark, sf):
    a = fr.articles(spark, sf).select("seq", T.normalize(F.col("title")).alias("norm"))
    return X.with_victim_counts(a, "norm").select("seq", *VICTIMS)


@check("x2_title_victims", ART + f"SELECT seq, {title_counts_sql('t')} FROM (SELECT seq, lower(title) AS t FROM art)")
def x2(spark, sf):
    a = fr.articles(spark, sf).select("seq", "title")
    return a.select("seq", X.title_victims(F.col("title")).alias("v")).select("seq", "v.*")


@check(
    "x2_title_victims_with_words",
    ART + f"SELECT seq, {title_counts_sql('t', True)} FROM (SELECT seq, lower(title) AS t FROM art)",
)
def x2w(spark, sf):
    a = fr.articles(spark, sf).select("seq", "title")
    return a.select("seq", X.title_victims(F.col("title"), number_words=True).alias("v")).select("seq", "v.*")


_ANY = "greatest(fatalities,injured,evacuated,displaced,missing) > 0"
# A url slug that states victims, and a body that does.
_X3_URL = "replace(page, l_orderkey||'-'||l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN n||'-feridos.html' ELSE 'noticia' END)"
_X3_BODY = "'Texto: '||(n+1)||' pessoas desalojadas na zona'"


def _pick_sql(*sources: str) -> str:
    cols = []
    for v in VICTIMS:
        case = "CASE " + " ".join(f"WHEN {_ANY.replace('fatalities', s+'.fatalities').replace('injured', s+'.injured').replace('evacuated', s+'.evacuated').replace('displaced', s+'.displaced').replace('missing', s+'.missing')} THEN {s}.{v}" for s in sources[:-1])
        cols.append(f"{case} ELSE {sources[-1]}.{v} END AS {v}")
    return ", ".join(cols)


@check(
    "x3_victim_cascade",
    ART + f", b AS (SELECT seq, l_linenumber, title, {_X3_URL} AS url, {_X3_BODY} AS body FROM art), "
    f"t AS (SELECT seq, {body_counts_sql(_words_sql(fr.norm_sql('title')))} FROM b), "
    f"u AS (SELECT seq, {body_counts_sql(_words_sql(fr.norm_sql('s')))} FROM (SELECT seq, "
    + r"regexp_replace(regexp_replace(regexp_replace(" + _SLUG + r",'[-_]+',' ','g'),'\.(html|htm|php)$',''),'[^\p{L}\p{N}_\s]','','g') AS s FROM b)), "
    f"d AS (SELECT seq, {body_counts_sql(_words_sql(fr.norm_sql('body')))} FROM b) "
    f"SELECT t.seq, {_pick_sql('t', 'u', 'd')} FROM t JOIN u USING (seq) JOIN d USING (seq)",
)
def x3(spark, sf):
    a = fr.articles(spark, sf)
    n = F.col("n").cast("string")
    tail = F.when(F.col("l_linenumber") % 2 == 0, F.concat(n, F.lit("-feridos.html"))).otherwise("noticia")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    b = a.select(
        "seq", "title", F.replace("page", key, tail).alias("url"),
        F.concat(F.lit("Texto: "), (F.col("n") + 1).cast("string"), F.lit(" pessoas desalojadas na zona")).alias("body"),
    )
    return b.select("seq", X.victims_title_url_body(F.col("title"), F.col("body"), F.col("url")).alias("v")).select("seq", "v.*")


@check(
    "x3_title_then_body",
    ART + f", b AS (SELECT seq, title, {_X3_BODY} AS body FROM art), t AS (SELECT seq, {title_counts_sql('lower(title)')} FROM b), "
    f"d AS (SELECT seq, {body_counts_sql(_words_sql(fr.norm_sql('body')))} FROM b) SELECT t.seq, {_pick_sql('t', 'd', 't')} FROM t JOIN d USING (seq)",
)
def x3b(spark, sf):
    a = fr.articles(spark, sf).select("seq", "title", "n")
    body = F.concat(F.lit("Texto: "), (F.col("n") + 1).cast("string"), F.lit(" pessoas desalojadas na zona"))
    return a.select("seq", X.victims_title_body(F.col("title"), body).alias("v")).select("seq", "v.*")


@check("x4_hazard_type", ART + f"SELECT seq, {_KIND} AS type, {_SUB} AS subtype FROM (SELECT seq, {fr.norm_sql('title')} AS norm FROM art)")
def x4(spark, sf):
    a = fr.articles(spark, sf).select("seq", T.normalize(F.col("title")).alias("norm"))
    return a.select("seq", X.hazard_type(F.col("norm")).alias("h")).select("seq", "h.*")


@check("x4_hazard_type_documents", f"SELECT doc_id, {_KIND} AS type, {_SUB} AS subtype FROM (SELECT doc_id, {fr.norm_sql('text')} AS norm FROM documents)")
def x4d(spark, sf):
    d = documents(spark, sf).select("doc_id", T.normalize(F.col("text")).alias("norm"))
    return d.select("doc_id", X.hazard_type(F.col("norm")).alias("h")).select("doc_id", "h.*")


_STORM = f"coalesce({fr.first_sql('lower(u)', vocab.STORM_NAMES)}, 'desconhecido')"


@check(
    "x5_storm_name",
    ART + f"SELECT k, {_STORM} AS evento_nome FROM (SELECT 'p'||page_id AS k, url AS u FROM pages UNION ALL SELECT seq, page FROM art)",
)
def x5(spark, sf):
    p = table(spark, sf, "pages").select(F.concat(F.lit("p"), "page_id").alias("k"), F.col("url").alias("u"))
    a = fr.articles(spark, sf).select(F.col("seq").alias("k"), F.col("page").alias("u"))
    return p.unionByName(a).select("k", X.storm_name(F.col("u")).alias("evento_nome"))


_KW = vocab.WEATHER_TERMS + ["tión", "stein"]


@check(
    "x6_mentions_hazard",
    f"SELECT doc_id, {fr.any_sql(fr.norm_sql('text'), [fold(k) for k in _KW])} AS hit, {fr.any_sql(fr.norm_sql('text'), _KW)} AS strict_hit FROM documents",
)
def x6(spark, sf):
    x = F.col("text")
    return documents(spark, sf).select(
        "doc_id", X.mentions_hazard(x, _KW).alias("hit"), X.mentions_hazard(x, _KW, strict=True).alias("strict_hit")
    )


@check(
    "x7_place_in_title",
    ART + f"SELECT seq, first.place FROM (SELECT seq, {fr.norm_sql('title')} AS norm FROM art) a LEFT JOIN LATERAL "
    f"(SELECT n_name AS place FROM nation WHERE contains(a.norm, lower(n_name)) ORDER BY n_nationkey LIMIT 1) first ON true",
)
def x7(spark, sf):
    a = fr.articles(spark, sf).select("seq", "title")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return geo.first_place_in_text(a, "seq", "title", n, "n_name", "n_nationkey").select("seq", "place")


@check(
    "x7_verified_location",
    ART + f"SELECT seq, upper(place) AS municipali, upper(district) AS district, CASE WHEN place IS NOT NULL THEN 'location based on text scraping' END AS georef FROM "
    f"(SELECT a.seq, min_by(n_name, n_nationkey) AS place, min_by(r_name, n_nationkey) AS district FROM (SELECT seq, {fr.norm_sql('title')} AS norm FROM art) a "
    "LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey=r_regionkey) n ON contains(a.norm, lower(n_name)) GROUP BY a.seq)",
)
def x7v(spark, sf):
    a = fr.articles(spark, sf).select("seq", "title")
    n = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "n_name", "r_name")
    hit = geo.first_place_in_text(a, "seq", "title", n.select("n_nationkey", "n_name"), "n_name", "n_nationkey")
    hit = hit.join(n.select(F.col("n_name").alias("place"), "r_name"), "place", "left")
    return geo.verified_location(hit, F.col("place"), F.col("r_name")).select("seq", "municipali", "district", "georef")


def _score_sql(text: str) -> tuple[str, str]:
    total = " + ".join(
        f"({' + '.join(f'contains({text}, {w!r})::INTEGER' for w in words)}) * {weight}"
        for weight, words in vocab.RELEVANCE.values()
    )
    cats = ", ".join(f"CASE WHEN {fr.any_sql(text, words)} THEN '{name}' END" for name, (_, words) in vocab.RELEVANCE.items())
    return f"({total})::INTEGER", f"concat_ws(',', {cats})"


SCORE, CATEGORIES = _score_sql("xt")
_GATE_URL_WORDS = ["cheia", "mortos", "granizo", "feridos"]


@check(
    "x8_relevance_score",
    ART + f"SELECT seq, {SCORE} AS score, {CATEGORIES} AS categories, "
    f"({' + '.join(f'contains(lower(page), {w!r})::INTEGER' for w in _GATE_URL_WORDS)})::INTEGER AS url_score FROM (SELECT *, lower(page)||' '||lower(title) AS xt FROM art)",
)
def x8(spark, sf):
    a = fr.articles(spark, sf).select("seq", "page", "title")
    return a.withColumn("r", X.relevance(F.col("page"), F.col("title"))).select(
        "seq", "r.score", F.array_join("r.categories", ",").alias("categories"),
        X.keyword_score(F.col("page"), _GATE_URL_WORDS).alias("url_score"),
    )


def gate_sql(text: str) -> tuple[str, str]:
    """Pass flag and matches ("keyword:weight,...") of the keyword gate."""
    hits = []
    for keyword, context, weight in vocab.GATE_POSITIVE:
        test = f"contains({text}, '{keyword}')"
        if context:
            test += f" AND NOT {fr.any_sql(text, context)}"
        hits.append((test, f"{keyword}:{weight}"))
    veto = fr.any_sql(text, vocab.GATE_NEGATIVE)
    passes = f"(({' OR '.join(f'({t})' for t, _ in hits)}) AND NOT {veto})"
    found = ", ".join(f"CASE WHEN {t} THEN '{label}' END" for t, label in hits)
    return passes, f"CASE WHEN {veto} THEN '' ELSE concat_ws(',', {found}) END"


GATE, GATE_MATCHES = gate_sql("g")


@check("x9_keyword_gate", ART + f"SELECT seq, {GATE} AS passes, {GATE_MATCHES} AS matches FROM (SELECT seq, lower(page) AS g FROM art)")
def x9(spark, sf):
    a = fr.articles(spark, sf).select("seq", "page")
    a = a.withColumn("g", X.keyword_gate(F.col("page")))
    label = F.transform("g.matches", lambda m: F.concat_ws(":", m["keyword"], m["weight"].cast("string")))
    return a.select("seq", "g.passes", F.array_join(label, ",").alias("matches"))


# The number as the title shows it: spelled out or in figures.
_SHOWN = f"(CASE WHEN l_linestatus = 'F' THEN {fr._case_sql('n', fr.WORDS, 'n::VARCHAR')} ELSE n::VARCHAR END)"
_SPAN_SQL = (
    "SELECT title AS text, label, length(term||' em '||district||': ')::INTEGER AS start, "
    f"(length(term||' em '||district||': ')+length({_SHOWN}))::INTEGER AS stop, n, seq FROM art"
)


@check(
    "x10_extractor_quality",
    ART + f", s AS ({_SPAN_SQL}), e AS (SELECT seq, {title_counts_sql('lower(text)')} FROM s), "
    "lab AS (SELECT * FROM e UNPIVOT (guess FOR label IN (fatalities, injured, evacuated, displaced, missing))), "
    "j AS (SELECT lab.label, lab.guess, CASE WHEN s.label = lab.label THEN s.n::INTEGER ELSE 0 END AS truth FROM lab JOIN s USING (seq)) "
    "SELECT upper(label) AS label, count_if(truth > 0)::BIGINT AS n_true, count_if(guess > 0)::BIGINT AS n_found, count_if(guess > 0 AND guess = truth)::BIGINT AS n_right, "
    "round(count_if(guess > 0 AND guess = truth)/nullif(count_if(guess > 0),0),4) AS precision, round(count_if(guess > 0 AND guess = truth)/nullif(count_if(truth > 0),0),4) AS recall "
    "FROM j GROUP BY label",
)
def x10(spark, sf):
    """Labelled spans sliced by offset against the title extractor, per label."""
    a = fr.articles(spark, sf)
    figures = F.col("n").cast("string")
    shown = F.when(F.col("l_linestatus") == "F", fr._case(F.col("n"), fr.WORDS, figures)).otherwise(figures)
    start = F.length(F.concat("term", F.lit(" em "), "district", F.lit(": ")))
    entity = F.struct(start.alias("start"), (start + F.length(shown)).alias("end"), F.upper("label").alias("label"))
    spans = gazetteer.explode_spans(a.select("title", F.array(entity).alias("entities")).withColumnRenamed("title", "text"))
    return report.span_quality(spans)
