"""Dated article lake: layers of ``stage/year/month/day`` and the choice between them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Export preference between stages.
STAGE_PRIORITY = {"victims": 1, "no_victims": 2, "all": 3}


def on_day(df: DataFrame, day: str | dt.date) -> DataFrame:
    """Rows of one day by partition columns, so other days are never listed."""
    d = dt.date.fromisoformat(str(day))
    return df.where((F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day))


def stage_rank(stage: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in STAGE_PRIORITY.items() for x in kv])
    return F.coalesce(F.element_at(table, stage), F.lit(len(STAGE_PRIORITY) + 1))


def best_stage(df: DataFrame, by: list[str], size: Column | None = None) -> DataFrame:
    """Per group the rows of the preferred existing stage (then of the larger one).

    Groups are counted first and only the small (group, stage) table is ranked.
    """
    weight = F.count(F.lit(1)) if size is None else F.sum(size)
    present = df.groupBy(*by, "stage").agg(weight.alias("_size"))
    best = present.groupBy(*by).agg(
        F.min_by("stage", F.struct(stage_rank(F.col("stage")), -F.col("_size"), "stage")).alias("stage")
    )
    return df.join(best, [*by, "stage"], "left_semi")


def first_existing(spark: SparkSession, paths: list[str], reader) -> DataFrame | None:
    """First path of a ranked list that exists, read with ``reader(path)``; else None."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        p = hadoop(path)
        if p.getFileSystem(conf).exists(p):
            return reader(path)
    return None


def dated_candidates(root: str, day: str | dt.date, name: str, stages=("structured", "raw")) -> list[str]:
    """Ranked places where a day's file may lie: dated folder, then plain folder."""
    d = dt.date.fromisoformat(str(day))
    dated = [f"{d:%Y-%m-%d}", f"{d:%Y%m%d}"]
    out = [
        f"{root}/{s}/{d:%Y/%m/%d}/{name}_{tag}.csv" for tag in dated for s in stages
    ]
    out += [f"{root}/{s}/{d:%Y/%m/%d}/{name}.csv" for s in stages]
    for s in stages:
        out += [f"{root}/{s}/{name}_{tag}.csv" for tag in dated]
        out.append(f"{root}/{s}/{name}.csv")
    return out


def date_of_file(name: Column) -> Column:
    """Date in a file name: YYYYMMDD or YYYY-MM-DD; null without one."""
    base = F.substring_index(name, "/", -1)
    compact = F.regexp_extract(base, r"(\d{8})", 1)
    dashed = F.regexp_extract(base, r"(\d{4}-\d{2}-\d{2})", 1)
    return F.coalesce(
        F.try_to_date(F.nullif(compact, F.lit("")), "yyyyMMdd"),
        F.try_to_date(F.nullif(dashed, F.lit("")), "yyyy-MM-dd"),
    )
