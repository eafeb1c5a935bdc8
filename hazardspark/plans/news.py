"""News plan: raw articles -> articles -> filtered articles, one lazy plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardspark import vocab
from hazardspark.functions import dates as D
from hazardspark.functions import extract as X
from hazardspark.functions import text as T
from hazardspark.operators import dedupe, filters, geo
from hazardspark.schemas import ARTICLE, VICTIMS
from hazardspark.session import rewritten


def process(
    raw: DataFrame,
    places: DataFrame,
    codes: DataFrame,
    as_of: str | dt.date,
    body: str | None = None,
    keywords: list[str] | None = None,
    number_words: bool = False,
) -> DataFrame:
    """RAW_ARTICLE rows to ARTICLE rows.

    Cheap title tests run before anything reads a body. A body is consulted
    only where the title has no victims; such rows need a hazard keyword in
    it. Without a ``body`` column titles alone decide and rows without victims
    in the title are kept.
    """
    rows = filters.has_required(raw, ["link", "title"])
    rows = rows.withColumn(
        "ID",
        F.coalesce(
            F.nullif(F.trim("ID"), F.lit("")), T.fallback_id(F.trim("link"), F.trim("title"))
        ),
    )
    rows = rows.withColumns({"title": T.strip(F.col("title")), "link": T.strip(F.col("link"))})
    rows = T.computed_once(rows, _low=F.lower("title"))
    rows = rows.where(~filters.is_off_topic(F.col("_low"), lowered=True)).drop("_low")
    rows = T.computed_once(
        rows, _tv=X.title_victims(F.col("title"), number_words), _norm=T.normalize(F.col("title"))
    )
    if body:
        # The body is touched only for rows without victims in the title.
        read = F.when(~X.any_victim(F.col("_tv")), F.col(body))
        rows = T.computed_once(rows, _body=T.normalize(read)).where(
            X.any_victim(F.col("_tv"))
            | T.contains_any(F.col("_body"), _folded(keywords or vocab.WEATHER_TERMS))
        )
        rows = rows.withColumn("_v", X.first_with_victims(F.col("_tv"), X.victims_in(F.col("_body"))))
    else:
        rows = rows.withColumn("_v", F.col("_tv"))
    rows = rows.withColumns(
        {"_hazard": X.hazard_type(F.col("_norm")), "_when": D.format_published(F.col("published"))}
    )
    rows = rows.withColumn("loc", T.strip(F.coalesce("localidade", F.lit(""))))
    clean = lambda c: T.clean_for_csv(F.col(c))
    # Place names are cleaned in the gazetteer, not once per article.
    tidy = places.withColumns({"district": clean("district"), "municipality": clean("municipality")})
    # Written first: Spark then knows the true size and joins small lists without shuffling the articles.
    rows = geo.enrich_place(rows, rewritten(tidy, "places"), rewritten(codes, "codes"))
    cols: dict[str, Column] = {
        "ID": F.col("ID"), "title": clean("title"),
        "type": F.col("_hazard.type"), "subtype": F.col("_hazard.subtype"),
        "date": F.col("_when.date"), "year": F.col("_when.year"), "month": F.col("_when.month"),
        "day": F.col("_when.day"), "hour": F.col("_when.hour"),
        "georef": clean("loc"), "district": F.col("district"), "municipali": F.col("municipality"),
        "parish": clean("loc"), "DICOFREG": F.col("DICOFREG"),
        "source": T.source_name(F.col("link")), "sourcedate": F.lit(str(as_of)),
        "sourcetype": F.lit("web"), "page": clean("link"),
        **{v: F.col(f"_v.{v}") for v in VICTIMS},
    }
    return rows.select(*[cols[n].alias(n) for n in ARTICLE.fieldNames()])


def _folded(words: list[str]) -> list[str]:
    import unicodedata

    return [
        unicodedata.normalize("NFKD", w.lower()).encode("ascii", "ignore").decode().strip() for w in words
    ]


def collect_new(raw: DataFrame, seen: DataFrame, order: str, exact: bool = True) -> DataFrame:
    """Raw articles that repeat no title or url of this run and no stored page."""
    first = dedupe.keep_first_title_or_url if exact else dedupe.keep_first_title_then_url
    return dedupe.not_yet_seen(
        first(raw, "title", "link", order).withColumn("page", F.col("link")), seen, "page"
    ).drop("page")
