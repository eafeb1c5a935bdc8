"""Publication plan: staging -> events -> main table, as one pure function per step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardspark.functions import dates as D
from hazardspark.operators import filters, geo
from hazardspark.operators.upsert import upsert
from hazardspark.schemas import EVENT, STAGING_UPDATE_COLS, VICTIMS


def events_of_staging(staging: DataFrame, stamp: Column) -> DataFrame:
    """Staging rows with a d/m/Y date as EVENT rows without coordinates."""
    day = D.staging_date(F.col("date"))
    word = lambda c, default: F.coalesce(F.col(c), F.lit(default))
    cols = {
        "id": F.col("ID"), "type": word("type", "Other"), "subtype": word("subtype", "Other"),
        "date": day, "year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day),
        "hour": word("hour", "08:00"),
        "latitude": F.lit(None), "longitude": F.lit(None),
        "georef_class": word("georef", "unknown"), "district": word("district", "unknown"),
        "municipality": word("municipali", "unknown"), "parish": word("parish", "unknown"),
        "dicofreg": F.col("DICOFREG"),
        **{v: F.coalesce(F.col(v), F.lit(0)) for v in VICTIMS},
        "source_name": F.col("source"), "source_date": D.parse_date(F.col("sourcedate")),
        "source_type": word("sourcetype", "news_article"), "page": F.col("page"),
        "location_geom": F.lit(None), "updated_at": stamp,
    }
    return staging.where(day.isNotNull()).select(
        *[cols[f.name].cast(f.dataType).alias(f.name) for f in EVENT.fields]
    )


@dataclass(frozen=True)
class Published:
    events: DataFrame
    main: DataFrame


def publish(
    staging: DataFrame,
    events: DataFrame,
    main: DataFrame,
    centroids: DataFrame,
    stamp: Column,
    update_cols: list[str] | None = None,
) -> Published:
    """Merge staging into events, locate them, merge the publishable ones into main.

    Events stay dealt by their id up to the main table, which takes none without one.
    """
    merged = upsert(
        events, events_of_staging(staging, stamp), "id",
        update_cols=update_cols or STAGING_UPDATE_COLS, updated_at=stamp, dealt=True,
    )
    levels = geo.written_levels(centroids)
    named = geo.with_geometry(geo.locate_by(merged.where(F.col("id").isNotNull()), levels, "id"))
    return Published(
        events=geo.with_geometry(geo.locate_by(merged, levels)),
        main=upsert(main, named.where(filters.publishable()), "id", updated_at=stamp),
    )
