"""Official catalogues to one event frame, and the fan-out to the star tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardspark import vocab
from hazardspark.functions import dates as D
from hazardspark.functions import text as T
from hazardspark.operators import geo
from hazardspark.operators.filters import catalogue_rows, column_or_null
from hazardspark.schemas import VICTIMS

# Columns of the common event frame ("wide" rows before the fan-out).
WIDE = [
    "catalogue", "type", "subtype", "date", "year", "month", "day", "hour", "latitude",
    "longitude", "georef_class", "district", "municipality", "parish", "dicofreg", *VICTIMS,
    "source_name", "source_date", "source_type", "page",
]


# --- proportional expansion ------------------------------------------------------------------


def location_parts(location: Column) -> Column:
    """Place names of a location text.

    Parentheses and the words district(s)/province(s) go, two names are
    corrected, then commas and the word "and" separate.
    """
    text = F.regexp_replace(location, r"\([^)]*\)", "")
    text = F.regexp_replace(text, r"\bdistricts?\b|\bprovinces?\b", "")
    text = F.replace(text, F.lit("Ilha Da Madeira"), F.lit("Funchal"))
    text = F.regexp_replace(text, r"\bLoure\b", "Loures")
    parts = F.transform(F.split(text, r",\s*|\band\b"), lambda p: F.btrim(p, F.lit(T.ASCII_SPACE)))
    return F.filter(parts, lambda p: F.length(p) > 0)


def share(total: Column, n: Column, position: Column) -> Column:
    """Part ``position`` (from 0) of an integer total split over n: sums are preserved."""
    base = F.floor(total / n).cast("bigint")
    return base + F.when(position < F.pmod(total, n), 1).otherwise(0)


def expand_locations(df: DataFrame) -> DataFrame:
    """One row per named place with its share of deaths, injured and homeless.

    Locations that yield no part disappear.
    """
    counts = {
        "split_deaths": "Total Deaths", "split_injured": "No. Injured", "split_homeless": "No. Homeless",
    }
    out = df.withColumn("_parts", location_parts(F.col("Location"))).withColumn(
        "split_count", F.size("_parts")
    )
    out = out.select("*", F.posexplode("_parts").alias("_pos", "_part"))
    out = out.withColumns(
        {
            name: share(T.safe_int(F.col(f"`{source}`")), F.col("split_count"), F.col("_pos"))
            for name, source in counts.items()
        }
    )
    return out.withColumn("Location", F.col("_part")).drop("_parts", "_pos", "_part")


# --- mappers ---------------------------------------------------------------------------------


def emdat_events(df: DataFrame, municipalities: DataFrame, centroids: DataFrame) -> DataFrame:
    """Portuguese floods of the EM-DAT table, one event per named place."""
    rows = expand_locations(df.where(catalogue_rows(F.col("Country"), F.col("`Disaster Type`"))))
    rows = geo.assign_district(rows, municipalities)
    rows = geo.municipality_point(rows, centroids)
    part = lambda c: F.coalesce(
        F.nullif(T.safe_int(F.col(c)), F.lit(0).cast("bigint")), F.lit(1).cast("bigint")
    )
    label = F.lit("www.emdat.be")
    return rows.select(
        F.lit("emdat").alias("catalogue"),
        T.safe_str(F.col("`Disaster Type`")).alias("type"),
        T.safe_str(F.coalesce(F.nullif(F.col("`Disaster Subtype`"), F.lit("")), F.lit("General flood"))).alias("subtype"),
        D.date_from_parts(F.col("`Start Year`"), F.col("`Start Month`"), F.col("`Start Day`")).alias("date"),
        T.safe_int(F.col("`Start Year`")).try_cast("int").alias("year"),
        part("`Start Month`").try_cast("int").alias("month"),
        part("`Start Day`").try_cast("int").alias("day"),
        F.lit("00:00-00:00").alias("hour"),
        "latitude", "longitude", "georef_class",
        T.safe_str(F.col("district")).alias("district"),
        T.safe_str(F.col("municipality")).alias("municipality"),
        F.col("Location").alias("parish"),
        F.lit(None).cast("string").alias("dicofreg"),
        F.col("split_deaths").cast("int").alias("fatalities"),
        F.col("split_injured").cast("int").alias("injured"),
        F.lit(0).alias("evacuated"),
        F.col("split_homeless").cast("int").alias("displaced"),
        F.lit(0).alias("missing"),
        label.alias("source_name"),
        D.parse_date(F.col("`Entry Date`")).alias("source_date"),
        label.alias("source_type"),
        F.lit("-").alias("page"),
    )


def _text_or_null(df: DataFrame, name: str) -> Column:
    return T.strip(column_or_null(df, name).cast("string"))


def eswd_events(df: DataFrame) -> DataFrame:
    """Severe-weather reports (see ``sources.catalogues.eswd`` for DATE and HOUR)."""
    detail = _text_or_null(df, "DETAILED_LOCATION")
    named = F.when(~F.lower(detail).isin("nan", "none", ""), detail)
    count = lambda c: F.coalesce(column_or_null(df, c, "int").try_cast("int"), F.lit(0)).alias(c.lower())
    lat = column_or_null(df, "LATITUDE", "double").try_cast("double")
    lon = column_or_null(df, "LONGITUDE", "double").try_cast("double")
    both = lat.isNotNull() & lon.isNotNull()
    return df.where(F.col("DATE").isNotNull()).select(
        F.lit("eswd").alias("catalogue"),
        F.coalesce(F.nullif(column_or_null(df, "TYPE_EVENT"), F.lit("")), F.lit("unknown")).alias("type"),
        F.lit("Heavy Rain").alias("subtype"),
        F.col("DATE").alias("date"),
        F.year("DATE").alias("year"), F.month("DATE").alias("month"), F.dayofmonth("DATE").alias("day"),
        F.col("HOUR").alias("hour"),
        F.when(both, lat).alias("latitude"), F.when(both, lon).alias("longitude"),
        F.lit(1).alias("georef_class"),
        _text_or_null(df, "STATE").alias("district"),
        _text_or_null(df, "PLACE").alias("municipality"),
        F.coalesce(named, _text_or_null(df, "PLACE")).alias("parish"),
        F.lit(None).cast("string").alias("dicofreg"),
        *[count(v.upper()) for v in VICTIMS],
        _text_or_null(df, "INFO_SOURCE").alias("source_name"),
        F.col("DATE").alias("source_date"),
        F.lit("online").alias("source_type"),
        _text_or_null(df, "EXT_URL").alias("page"),
    )


def feature_events(df: DataFrame, source: str = "feature-service", district_col: str = "Concelho") -> DataFrame:
    """Feature-service attributes; a missing date becomes 1900-01-01, a missing point (0, 0).

    The district is filled from ``district_col`` (the municipality by default).
    """
    iso = column_or_null(df, "DataInicioOcorrencia")
    ms = column_or_null(df, "DataOcorrencia", "bigint")
    stamp = D.iso_or_millis(iso, ms)
    day = stamp.cast("date")
    text = lambda c: T.safe_str(F.coalesce(column_or_null(df, c), F.lit("")))
    number = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    lat = column_or_null(df, "Latitude", "double")
    lon = column_or_null(df, "Longitude", "double")
    both = lat.isNotNull() & lon.isNotNull()
    return df.select(
        F.lit("features").alias("catalogue"),
        text("Natureza").alias("type"),
        F.lit(None).cast("string").alias("subtype"),
        F.coalesce(day, F.to_date(F.lit("1900-01-01"))).alias("date"),
        number(F.year(day)).alias("year"), number(F.month(day)).alias("month"),
        number(F.dayofmonth(day)).alias("day"),
        F.coalesce(F.date_format(stamp, "HH:mm"), F.lit("")).alias("hour"),
        F.when(both, lat).otherwise(F.lit(0.0)).alias("latitude"),
        F.when(both, lon).otherwise(F.lit(0.0)).alias("longitude"),
        F.lit(1).alias("georef_class"),
        text(district_col).alias("district"), text("Concelho").alias("municipality"),
        text("Freguesia").alias("parish"), text("DICOFRE").alias("dicofreg"),
        *[F.lit(0).alias(v) for v in VICTIMS],
        F.lit(source).alias("source_name"),
        D.from_millis(column_or_null(df, "DataDosDados", "bigint")).cast("date").alias("source_date"),
        F.lit("ArcGISFeatureServer").alias("source_type"),
        F.lit("0").alias("page"),
    )


def report_events(df: DataFrame) -> DataFrame:
    """Historical reports (the ``pts`` shape); dates are day-first with part fallback."""
    text = lambda c: T.safe_str(F.coalesce(column_or_null(df, c), F.lit(""))).alias(c)
    whole = lambda c: T.safe_int(column_or_null(df, c)).try_cast("int")
    return df.select(
        F.lit("reports").alias("catalogue"),
        text("type"), text("subtype"),
        D.day_first_date(
            column_or_null(df, "date"), column_or_null(df, "year"), column_or_null(df, "month"),
            column_or_null(df, "day"),
        ).alias("date"),
        whole("year").alias("year"), whole("month").alias("month"), whole("day").alias("day"),
        text("hour"),
        F.coalesce(column_or_null(df, "latitude", "double").try_cast("double"), F.lit(0.0)).alias("latitude"),
        F.coalesce(column_or_null(df, "longitude", "double").try_cast("double"), F.lit(0.0)).alias("longitude"),
        F.coalesce(F.nullif(whole("georef"), F.lit(0)), F.lit(1)).alias("georef_class"),
        text("district"), text("municipality"), text("parish"), text("dicofreg"),
        *[whole(v).alias(v) for v in VICTIMS],
        T.safe_str(F.coalesce(column_or_null(df, "source"), F.lit(""))).alias("source_name"),
        D.parse_date(column_or_null(df, "sourcedate")).alias("source_date"),
        T.safe_str(F.coalesce(column_or_null(df, "sourcetype"), F.lit(""))).alias("source_type"),
        text("page"),
    )


def union_events(*frames: DataFrame) -> DataFrame:
    """All catalogues in the common shape."""
    out = frames[0].select(*WIDE)
    for frame in frames[1:]:
        out = out.unionByName(frame.select(*WIDE))
    return out


# --- star ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Star:
    disasters: DataFrame
    location: DataFrame
    human_impacts: DataFrame
    information_sources: DataFrame


COPIES_PER_TASK_ROW = 10_000


def with_event_id(wide: DataFrame) -> DataFrame:
    """``id`` = md5 of the row's values and its ordinal among equal rows.

    Every value is written with its length, a null as a dash, so that rows
    that differ never read the same.

    The same input always gets the same ids, in any order and on any cluster.
    Equal rows are counted by an aggregate and re-expanded. A row with very
    many copies is expanded in blocks that are dealt out first, so no task
    writes all copies of one row; both branches reuse the same shuffle.
    """
    columns = wide.columns
    block = F.lit(COPIES_PER_TASK_ROW)
    counted = wide.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    few = counted.where(F.col("_n") <= block).withColumn("_block", F.lit(0).cast("bigint"))
    many = counted.where(F.col("_n") > block).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / block)))
    )
    dealt = few.unionByName(many.repartition(F.xxhash64("_block", *columns)))
    first = F.col("_block") * block + 1
    last = F.least(F.col("_n"), (F.col("_block") + 1) * block)
    rows = dealt.select(*columns, F.explode(F.sequence(first, last)).alias("_ordinal"))
    sized = lambda c: F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    text = F.concat_ws("|", *[sized(F.col(f"`{c}`").cast("string")) for c in columns], F.col("_ordinal").cast("string"))
    return rows.select(F.md5(text.cast("binary")).alias("id"), *columns)


def fan_out(keyed: DataFrame) -> Star:
    """The four star tables of event rows with an ``id``; no location row without a point."""
    return Star(
        disasters=keyed.select("id", "type", "subtype", "date", "year", "month", "day", "hour"),
        location=keyed.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
            "id", "latitude", "longitude", "georef_class", "district", "municipality", "parish",
            "dicofreg", T.wkt_point(F.col("latitude"), F.col("longitude")).alias("geom"),
        ),
        human_impacts=keyed.select("id", *VICTIMS),
        information_sources=keyed.select(
            F.col("id").alias("disaster_id"), "source_name", "source_date", "source_type", "page"
        ),
    )


def split_rejects(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows; one bad row never takes others with it."""
    ok = F.coalesce(valid, F.lit(False))
    return df.where(ok), df.where(~ok)


def report_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reports that can be mapped, and those whose coordinates are given but are no numbers."""
    readable = lambda c: column_or_null(df, c).isNull() | column_or_null(df, c).try_cast("double").isNotNull()
    return split_rejects(df, readable("latitude") & readable("longitude"))
