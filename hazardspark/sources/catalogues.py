"""Catalogue scans: severe-weather CSV, tabular catalogues, landed feature pages, RSS items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardspark import schemas
from hazardspark.functions import text as T
from hazardspark.sources.tables import tidy_headers


def eswd(df: DataFrame) -> DataFrame:
    """Upper-case headers, rows with TIME_EVENT, parsed time with DATE and HOUR."""
    out = tidy_headers(df, upper=True).where(F.col("TIME_EVENT").isNotNull())
    stamp = F.try_to_timestamp(F.col("TIME_EVENT").cast("string"))
    return out.withColumn("TIME_EVENT", stamp).withColumns(
        {"DATE": F.to_date("TIME_EVENT"), "HOUR": F.date_format("TIME_EVENT", "HH:mm")}
    )


def tabular(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Lower-case headers; ``municipali`` becomes ``municipality``."""
    return tidy_headers(df).withColumnsRenamed(renames or {"municipali": "municipality"})


def feature_pages(spark: SparkSession, path: str, kind: str | None = "Cheia") -> DataFrame:
    """Attributes of landed feature pages (one JSON object per page file).

    Empty pages add nothing; ``kind`` keeps one nature of event.
    """
    pages = spark.read.schema(schemas.FEATURE_PAGE).option("multiLine", "true").json(path)
    rows = pages.select(F.explode("features").alias("f")).select("f.attributes.*")
    return rows if kind is None else rows.where(F.col("Natureza") == kind)


def feature_lines(df: DataFrame, column: str, kind: str | None = "Cheia") -> DataFrame:
    """The same for pages held as JSON text in a column."""
    pages = df.select(F.from_json(column, schemas.FEATURE_PAGE).alias("page"))
    rows = pages.select(F.explode("page.features").alias("f")).select("f.attributes.*")
    return rows if kind is None else rows.where(F.col("Natureza") == kind)


RSS_ITEM = "struct<title:string,link:string,pubDate:string>"


def _raw_article(df: DataFrame) -> DataFrame:
    """RAW_ARTICLE rows; items without link, title or date are dropped."""
    out = df.withColumns({"title": T.strip(F.col("title")), "ID": T.url_id(F.col("link"))})
    filled = [F.coalesce(F.length(F.col(c)) > 0, F.lit(False)) for c in ("title", "link", "published")]
    return out.where(filled[0] & filled[1] & filled[2]).select(*schemas.RAW_ARTICLE.fieldNames())


def rss_files(spark: SparkSession, path: str, keyword: str, localidade: str, collected: str) -> DataFrame:
    """Items of landed RSS files of one search."""
    items = (
        spark.read.format("xml").option("rowTag", "item")
        .schema("title string, link string, pubDate string").load(path)
    )
    return _raw_article(
        items.select(
            F.lit(keyword).alias("keyword"), F.lit(localidade).alias("localidade"), "title", "link",
            F.col("pubDate").alias("published"), F.lit(collected).alias("collection_date"),
        )
    )


def rss_items(df: DataFrame, xml: str) -> DataFrame:
    """Items held as XML text, beside keyword, localidade and collection_date."""
    parsed = df.withColumn("_i", F.from_xml(F.col(xml), RSS_ITEM))
    return _raw_article(
        parsed.select(
            "keyword", "localidade", F.col("_i.title").alias("title"), F.col("_i.link").alias("link"),
            F.col("_i.pubDate").alias("published"), "collection_date",
        )
    )


def html_pages(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Pages with their main text."""
    from hazardspark.functions.html import article_text, bounded_pages

    return bounded_pages(df).withColumn(out, article_text(F.col(html)))
