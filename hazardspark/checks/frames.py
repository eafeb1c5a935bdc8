"""Driver tables reshaped to the package's inputs, in Spark and as SQL CTEs.

The given tables hold no Portuguese news, so headlines, gazetteers, centroids
and catalogues are composed from their columns by expressions both engines
share. Every frame uses the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardspark.checks.base import table
from hazardspark.functions import text as T

TERMS = [
    ("Cheia rápida", "cheia-rapida", "Flood", "flash_flood"),
    ("Inundação na cidade", "inundacao-na-cidade", "Flood", "urban_flood"),
    ("Deslizamento de lama", "deslizamento-de-lama", "Landslide", "mudslide"),
    ("Incêndio florestal", "incendio-florestal", "Fire", "wildfire"),
    ("Tempestade Elsa com granizo", "tempestade-elsa-com-granizo", "Storm", "hailstorm"),
]
PHRASES = [
    ("A", "F", "mortos", "fatalities"),
    ("A", "O", "pessoas mortas", "fatalities"),
    ("N", "F", "feridos", "injured"),
    ("N", "O", "pessoas evacuadas", "evacuated"),
    ("R", "F", "desalojados", "displaced"),
    ("R", "O", "desaparecidos", "missing"),
]
OUTLETS = [
    ("1-URGENT", "publico.pt"), ("2-HIGH", "jn.pt"), ("3-MEDIUM", "blog-global.com"),
    ("4-NOT SPECIFIED", "observador.pt"), ("5-LOW", "facebook.com/forum"),
]
WORDS = [(1, "um"), (2, "dois"), (3, "três")]


def _case(subject: Column, pairs: list[tuple], default=None) -> Column:
    out = None
    for value, result in pairs:
        out = F.when(subject == value, result) if out is None else out.when(subject == value, result)
    return out if default is None else out.otherwise(default)


def _case_sql(subject: str, pairs: list[tuple], default: str = "NULL") -> str:
    lit = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {subject} " + " ".join(f"WHEN {lit(a)} THEN {lit(b)}" for a, b in pairs) + f" ELSE {default} END"


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """News articles, one per line item."""
    l = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    )
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    # Orders meet customers first: the line items, four times as many, are shuffled once.
    placed = o.join(c.join(n, F.col("c_nationkey") == F.col("n_nationkey")), F.col("o_custkey") == F.col("c_custkey"))
    joined = l.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    pad = lambda x, w: F.lpad(x.cast("string"), w, "0")
    kind = F.col("l_linenumber") % 5
    flags = F.concat("l_returnflag", "l_linestatus")
    phrase = _case(flags, [(a + b, p) for a, b, p, _ in PHRASES])
    label = _case(flags, [(a + b, v) for a, b, _, v in PHRASES])
    n_ = F.col("l_quantity").cast("int") * F.when(F.col("l_linenumber") == 7, 100).otherwise(1)
    day = F.col("o_orderdate")
    out = joined.select(
        F.concat_ws(
            "-", pad(F.col("l_orderkey"), 12), F.col("l_linenumber").cast("string"),
            pad(F.col("l_partkey"), 12), pad(F.col("l_suppkey"), 10),
            pad(F.round(F.col("l_extendedprice") * 100).cast("bigint"), 14),
        ).alias("seq"),
        "l_orderkey", "l_partkey", "l_linenumber", "l_discount", "l_tax", "l_linestatus",
        _case(kind, [(i, t[0]) for i, t in enumerate(TERMS)]).alias("term"),
        _case(kind, [(i, t[1]) for i, t in enumerate(TERMS)]).alias("slug"),
        _case(kind, [(i, t[2]) for i, t in enumerate(TERMS)]).alias("type"),
        _case(kind, [(i, t[3]) for i, t in enumerate(TERMS)]).alias("subtype"),
        phrase.alias("phrase"), label.alias("label"), n_.alias("n"),
        _case(F.col("o_orderpriority"), OUTLETS).alias("outlet"),
        F.to_date(day).alias("day_date"),
        F.date_format(day, "dd/MM/yyyy").alias("date"),
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        F.format_string("%02d:00", F.col("l_linenumber")).alias("hour"),
        F.col("n_name").alias("district"),
        F.concat_ws(" ", "n_name", "c_mktsegment").alias("municipali"),
        F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.col("c_name")).alias("parish"),
        pad(F.col("c_custkey"), 6).alias("DICOFREG"),
    )
    # Victim counts act as stored columns: predicates on them are not pushed into the CASEs.
    out = T.computed_once(
        out,
        **{v: F.when(F.col("label") == v, F.col("n")).otherwise(0) for v in
           ("fatalities", "injured", "evacuated", "displaced", "missing")},
    )
    number = F.when(
        F.col("l_linestatus") == "F", _case(F.col("n"), WORDS, F.col("n").cast("string"))
    ).otherwise(F.col("n").cast("string"))
    out = out.withColumns(
        {
            "title": F.concat(
                "term", F.lit(" em "), "district", F.lit(": "), number, F.lit(" "), "phrase",
                F.when(F.col("l_tax") >= 0.075, " (desporto)").otherwise(""),
            ),
            "link": F.concat(
                F.lit("https://www."), "outlet", F.lit("/"), "slug", F.lit("-"),
                F.replace("phrase", F.lit(" "), F.lit("-")),
                F.when(F.col("l_discount") >= 0.095, "-aviso").otherwise(""), F.lit("/"),
                F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"),
                F.lit("?ref="), F.col("l_partkey").cast("string"),
            ),
        }
    )
    return out.withColumns(
        {
            "ID": F.md5(F.col("seq").cast("binary")),
            "page": F.split_part("link", F.lit("?"), F.lit(1)),
            "localidade": F.col("municipali"),
            "keyword": F.lit("cheias"),
            "georef": F.col("municipali"),
            "source": F.substring_index("outlet", ".", 1),
            "sourcedate": F.date_format("day_date", "yyyy-MM-dd"),
            "sourcetype": F.lit("web"),
        }
    )


_PHRASE_SQL = _case_sql("l_returnflag||l_linestatus", [(a + b, p) for a, b, p, _ in PHRASES])
_LABEL_SQL = _case_sql("l_returnflag||l_linestatus", [(a + b, v) for a, b, _, v in PHRASES])
_KIND = "l_linenumber % 5"

ART = f"""
art0 AS (
 SELECT lpad(l_orderkey::VARCHAR,12,'0')||'-'||l_linenumber||'-'||lpad(l_partkey::VARCHAR,12,'0')||'-'
   ||lpad(l_suppkey::VARCHAR,10,'0')||'-'||lpad(round(l_extendedprice*100)::BIGINT::VARCHAR,14,'0') AS seq,
  l_orderkey, l_partkey, l_linenumber, l_discount, l_tax, l_linestatus,
  {_case_sql(_KIND, [(i, t[0]) for i, t in enumerate(TERMS)])} AS term,
  {_case_sql(_KIND, [(i, t[1]) for i, t in enumerate(TERMS)])} AS slug,
  {_case_sql(_KIND, [(i, t[2]) for i, t in enumerate(TERMS)])} AS type,
  {_case_sql(_KIND, [(i, t[3]) for i, t in enumerate(TERMS)])} AS subtype,
  {_PHRASE_SQL} AS phrase, {_LABEL_SQL} AS label,
  (l_quantity::INTEGER * CASE WHEN l_linenumber = 7 THEN 100 ELSE 1 END)::INTEGER AS n,
  {_case_sql('o_orderpriority', OUTLETS)} AS outlet,
  o_orderdate::DATE AS day_date, strftime(o_orderdate, '%d/%m/%Y') AS date,
  year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS day,
  '0'||l_linenumber||':00' AS hour,
  n_name AS district, n_name||' '||c_mktsegment AS municipali,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS parish,
  lpad(c_custkey::VARCHAR,6,'0') AS DICOFREG
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey),
art1 AS (
 SELECT *, term||' em '||district||': '||
   CASE WHEN l_linestatus = 'F' THEN {_case_sql('n', WORDS, 'n::VARCHAR')} ELSE n::VARCHAR END
   ||' '||phrase||CASE WHEN l_tax >= 0.075 THEN ' (desporto)' ELSE '' END AS title,
  'https://www.'||outlet||'/'||slug||'-'||replace(phrase,' ','-')
   ||CASE WHEN l_discount >= 0.095 THEN '-aviso' ELSE '' END||'/'||l_orderkey||'-'||l_linenumber
   ||'?ref='||l_partkey AS link,
  CASE WHEN label='fatalities' THEN n ELSE 0 END AS fatalities,
  CASE WHEN label='injured' THEN n ELSE 0 END AS injured,
  CASE WHEN label='evacuated' THEN n ELSE 0 END AS evacuated,
  CASE WHEN label='displaced' THEN n ELSE 0 END AS displaced,
  CASE WHEN label='missing' THEN n ELSE 0 END AS missing
 FROM art0),
art AS (
 SELECT *, md5(seq) AS ID, split_part(link,'?',1) AS page, municipali AS localidade, 'cheias' AS keyword,
  municipali AS georef, split_part(outlet,'.',1) AS source,
  strftime(day_date,'%Y-%m-%d') AS sourcedate, 'web' AS sourcetype
 FROM art1)
"""


def published(df: DataFrame) -> DataFrame:
    """RSS publication date from day and hour."""
    stamp = F.date_format("day_date", "EEE, dd MMM yyyy ")
    return df.withColumn("published", F.concat(stamp, "hour", F.lit(":00 GMT")))


PUBLISHED = "strftime(day_date, '%a, %d %b %Y ')||hour||':00 GMT'"


def gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """province, district, municipality, parish, code: one row per customer."""
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    return (
        c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("r_name").alias("province"), F.col("n_name").alias("district"),
            F.concat_ws(" ", "n_name", "c_mktsegment").alias("municipality"),
            F.col("c_name").alias("parish"), F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("code"),
            "c_custkey", "n_nationkey",
        )
    )


GAZ = """
gaz AS (
 SELECT r_name AS province, n_name AS district, n_name||' '||c_mktsegment AS municipality, c_name AS parish,
  lpad(c_custkey::VARCHAR,6,'0') AS code, c_custkey, n_nationkey
 FROM customer JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey)
"""


def renamed(df: DataFrame, name: str, where) -> DataFrame:
    """Rows that meet the condition go by another name: they are read and joined, and nothing finds them."""
    return df.withColumn(name, F.concat(F.when(where, "Old ").otherwise(""), name))


def valid_districts(spark: SparkSession, sf: str) -> DataFrame:
    """Title-cased names of all nations; a fifth goes by another name."""
    n = renamed(table(spark, sf, "nation"), "n_name", F.col("n_nationkey") % 5 == 4)
    return n.select(F.initcap("n_name").alias("district"))


def valid_parishes(spark: SparkSession, sf: str) -> DataFrame:
    c = renamed(table(spark, sf, "customer"), "c_name", F.col("c_custkey") % 11 == 0)
    return c.select(F.col("c_name").alias("parish"))


VALID = """
vd AS (SELECT CASE WHEN n_nationkey % 5 = 4 THEN 'Old N'||lower(substr(n_name,2)) ELSE upper(left(n_name,1))||lower(substr(n_name,2)) END AS district FROM nation),
vp AS (SELECT CASE WHEN c_custkey % 11 = 0 THEN 'Old ' ELSE '' END||c_name AS parish FROM customer)
"""


def centroids(spark: SparkSession, sf: str) -> DataFrame:
    """Parish, municipality and district points; a third of the parishes is missing."""
    g = gazetteer(spark, sf)
    lat = F.lit(37.0) + (F.col("c_custkey") % 500) / 100
    lon = F.lit(-9.0) + (F.col("c_custkey") % 250) / 100
    null = F.lit(None).cast("string")
    parish = g.where(F.col("c_custkey") % 3 != 0).select(
        F.round(lat, 2).alias("latitude"), F.round(lon, 2).alias("longitude"),
        F.col("district").alias("distrito"), F.col("municipality").alias("concelho"),
        F.col("parish").alias("freguesia"), F.col("code").alias("dicofre"),
    )
    municipality = g.where(F.col("n_nationkey") % 2 == 0).groupBy("district", "municipality", "n_nationkey").agg(
        F.min("code").alias("dicofre")
    ).select(
        F.round(F.lit(38.0) + F.col("n_nationkey") / 100, 2).alias("latitude"),
        F.round(F.lit(-8.0) - F.col("n_nationkey") / 100, 2).alias("longitude"),
        F.col("district").alias("distrito"), F.col("municipality").alias("concelho"),
        null.alias("freguesia"), "dicofre",
    )
    district = g.where(F.col("n_nationkey") % 5 != 3).groupBy("district", "n_nationkey").agg(
        F.min("code").alias("dicofre")
    ).select(
        F.round(F.lit(39.0) + F.col("n_nationkey") / 100, 2).alias("latitude"),
        F.round(F.lit(-7.0) - F.col("n_nationkey") / 100, 2).alias("longitude"),
        F.col("district").alias("distrito"), null.alias("concelho"), null.alias("freguesia"), "dicofre",
    )
    return parish.unionByName(municipality).unionByName(district)


CEN = GAZ + """,
cen AS (
 SELECT round(37.0::DOUBLE+(c_custkey%500)/100.0::DOUBLE,2) AS latitude, round(-9.0::DOUBLE+(c_custkey%250)/100.0::DOUBLE,2) AS longitude,
  district AS distrito, municipality AS concelho, parish AS freguesia, code AS dicofre FROM gaz WHERE c_custkey % 3 <> 0
 UNION ALL
 SELECT round(38.0::DOUBLE+n_nationkey/100.0::DOUBLE,2), round(-8.0::DOUBLE-n_nationkey/100.0::DOUBLE,2), district, municipality, NULL, min(code)
 FROM gaz WHERE n_nationkey % 2 = 0 GROUP BY district, municipality, n_nationkey
 UNION ALL
 SELECT round(39.0::DOUBLE+n_nationkey/100.0::DOUBLE,2), round(-7.0::DOUBLE-n_nationkey/100.0::DOUBLE,2), district, NULL, NULL, min(code)
 FROM gaz WHERE n_nationkey % 5 <> 3 GROUP BY district, n_nationkey)
"""


def disasters(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as disasters: O floods, F landslides, P fires."""
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"), "o_custkey",
        _case(F.col("o_orderstatus"), [("O", "FLOOD"), ("F", "landslide"), ("P", "fire")]).alias("type"),
        F.lit("General").alias("subtype"),
        F.to_date("o_orderdate").alias("date"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("day"),
    )


DIS = """
dis AS (
 SELECT o_orderkey AS id, o_custkey, CASE o_orderstatus WHEN 'O' THEN 'FLOOD' WHEN 'F' THEN 'landslide' ELSE 'fire' END AS type,
  'General' AS subtype, o_orderdate::DATE AS date, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month,
  day(o_orderdate)::INTEGER AS day FROM orders)
"""


def impacts(spark: SparkSession, sf: str) -> DataFrame:
    """Victims per order: quantities of its lines."""
    l = table(spark, sf, "lineitem")
    return l.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("fatalities")
    )


IMP = """
imp AS (SELECT l_orderkey AS id, sum(l_quantity::BIGINT)::BIGINT AS fatalities FROM lineitem GROUP BY 1)
"""


def locations(spark: SparkSession, sf: str) -> DataFrame:
    """One place per order; some points are missing or the -999 sentinel."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    lat = F.when(k % 13 == 0, None).when(k % 17 == 0, -999.0).otherwise(F.round(F.lit(37.0) + (k % 500) / 100, 2))
    return (
        o.join(c, F.col("o_custkey") == k).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("id"), lat.alias("latitude"),
            F.round(F.lit(-9.0) + (k % 250) / 100, 2).alias("longitude"),
            F.when(k % 19 == 0, "").otherwise(F.concat(F.lit(" "), F.lower("n_name"))).alias("district"),
            F.concat_ws("-", F.lower("n_name"), F.lower("c_mktsegment")).alias("municipality"),
        )
    )


LOC = """
loc AS (
 SELECT o_orderkey AS id,
  CASE WHEN c_custkey%13=0 THEN NULL WHEN c_custkey%17=0 THEN -999.0::DOUBLE ELSE round(37.0::DOUBLE+(c_custkey%500)/100.0::DOUBLE,2) END AS latitude,
  round(-9.0::DOUBLE+(c_custkey%250)/100.0::DOUBLE,2) AS longitude,
  CASE WHEN c_custkey%19=0 THEN '' ELSE ' '||lower(n_name) END AS district,
  lower(n_name)||'-'||lower(c_mktsegment) AS municipality
 FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey)
"""


def title_sql(x: str) -> str:
    """Title case of an ASCII SQL text."""
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({x}), '[a-z]+|[^a-z]+'), "
        "lambda y: upper(left(y,1))||substr(y,2)), '')"
    )


def capital_sql(x: str) -> str:
    return f"(upper(left({x},1))||lower(substr({x},2)))"


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per year, month and status."""
    d = disasters(spark, sf)
    return d.groupBy("year", "month", F.initcap("type").alias("type")).agg(
        F.count(F.lit(1)).alias("ocorrencias")
    )


MON = DIS + f""",
mon AS (SELECT year, month, {capital_sql('type')} AS type, count(*) AS ocorrencias FROM dis GROUP BY ALL)
"""

UNI_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{UNI_SPACE}+|{UNI_SPACE}+$', '', 'g')"


def norm_sql(x: str) -> str:
    return (
        f"regexp_replace(regexp_replace(strip_accents(lower(coalesce({x},''))), '[^\\x00-\\x7F]', '', 'g'), "
        r"'^[\s\x0b\x1c-\x1f]+|[\s\x0b\x1c-\x1f]+$', '', 'g')"
    )


NUMERIC = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number_sql(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{NUMERIC}') THEN try_cast(trim({x}) AS DOUBLE) END"


def safe_int_sql(x: str) -> str:
    n = number_sql(x)
    return f"coalesce(CASE WHEN {n} > 2147483647 THEN 2147483647 ELSE trunc({n})::BIGINT END, 0)"


def count_sql(x: str) -> str:
    return f"coalesce(try_cast(trunc({number_sql(x)}) AS INTEGER), 0)"


def any_sql(x: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, '{t}')" for t in terms) + ")"


def first_sql(x: str, terms: list[str]) -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN contains({x}, '{t}') THEN '{t}' END" for t in terms) + ")"


def texts(*names: str) -> str:
    return "WITH " + ", ".join(n.strip() for n in names) + " "
