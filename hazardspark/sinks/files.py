"""File sinks: fixed and dynamic CSV projections, dated lake, routed outputs, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardspark import schemas
from hazardspark.operators.filters import any_victims

_CSV = {"header": "true", "quote": '"', "escape": '"'}


def fixed_projection(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Exactly the listed columns as text; missing ones and nulls are ''."""
    columns = columns or schemas.ARTICLE_CSV
    have = set(df.columns)
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")
    return df.select(*[cell(c).alias(c) for c in columns])


def disaster_ready(df: DataFrame) -> DataFrame:
    """The 18-column projection of rows with a victim count above 0."""
    return fixed_projection(df.where(any_victims()), schemas.DISASTER_READY_CSV)


def dynamic_projection(df: DataFrame) -> DataFrame:
    """Standard columns that exist in standard order, then the others by name."""
    standard = [c for c in schemas.ARTICLE_CSV if c in df.columns]
    extra = sorted(c for c in df.columns if c not in schemas.ARTICLE_CSV)
    return fixed_projection(df, standard + extra)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """CSV with empty strings kept empty; ``compression`` such as gzip shrinks the files, which readers know by their names."""
    df.write.mode(mode).options(**_CSV, emptyValue="", compression=compression).csv(path)


def write_dated(df: DataFrame, path: str, date: Column, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Lake layout year/month/day; only the touched days are replaced.

    Rows are rebalanced on the day: small days share a writer, and a day that
    holds a third of the table is split over many.
    """
    dated = df.withColumns(
        {"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)}
    ).hint("rebalance", "year", "month", "day")
    (
        dated.write.mode(mode).format(fmt)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", "day")
        .save(path)
    )


def write_routed(df: DataFrame, path: str, route: Column, columns: list[str] | None = None) -> None:
    """One folder per route value in one pass over the input."""
    routed = df.withColumn("route", route)
    out = routed if columns is None else routed.select("route", *columns)
    out.write.mode("overwrite").partitionBy("route").parquet(path)


def append_and_snapshot(df: DataFrame, history: str, latest: str) -> None:
    """Append to the history, replace the latest snapshot with this batch only."""
    df.write.mode("append").parquet(history)
    df.write.mode("overwrite").parquet(latest)


def write_empty(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """A readable, empty output with the right columns."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def export_tables(tables: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Several tables below one folder."""
    for name, df in tables.items():
        df.write.mode("overwrite").format(fmt).option("header", "true").save(f"{path}/{name}")
