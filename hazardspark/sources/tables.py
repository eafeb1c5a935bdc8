"""Table and file scans with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardspark import schemas

CSV_OPTIONS = {
    "header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
}


def csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Quoted CSV with a header; cells may hold line breaks."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


REJECTED = "_rejected"


def csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = True, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV, and its malformed records as (file, record).

    A record with too few or too many cells, or a cell that its column's type cannot hold, is rejected as a whole instead
    of leaving nulls among the good rows. Without line breaks in cells (``line_breaks=False``) a file is divided among
    tasks; with them it is read by one.
    """
    options = CSV_OPTIONS | {"multiLine": str(line_breaks).lower(), "header": str(header).lower(), "columnNameOfCorruptRecord": REJECTED, "columnPruning": "false"}
    read = spark.read.options(**options).schema(T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])).csv(path)
    # A cell that nothing reads is not parsed and cannot be malformed: both sides read them all, whatever is selected later.
    cells = [F.col(f"`{c}`") for c in schema.fieldNames()]
    good = read.where(F.col(REJECTED).isNull() & (F.hash(*cells) % 2 < 2)).select(*cells)
    record = F.coalesce(F.col(REJECTED), F.to_json(F.struct(*cells)))
    bad = read.where(F.col(REJECTED).isNotNull()).select(F.input_file_name().alias("file"), record.alias("record"))
    return good, bad


def articles(spark: SparkSession, path: str) -> DataFrame:
    return csv_table(spark, path, schemas.ARTICLE)


def raw_articles(spark: SparkSession, path: str) -> DataFrame:
    return csv_table(spark, path, schemas.RAW_ARTICLE)


def tidy_headers(df: DataFrame, upper: bool = False) -> DataFrame:
    """Column names trimmed and in one case."""
    names = [c.strip() for c in df.columns]
    return df.toDF(*[n.upper() if upper else n.lower() for n in names])


def query_table(
    df: DataFrame, columns: str = "*", limit_rows: int | None = None, order: list | None = None
) -> DataFrame:
    """Column list of a table, optionally the first rows of an ordering.

    Works on any frame: ``spark.table``, Parquet or :func:`jdbc_table`; the
    column list reaches the scan.
    """
    out = df if columns.strip() == "*" else df.select(*[c.strip() for c in columns.split(",")])
    if limit_rows is not None:
        if order:
            out = out.orderBy(*order)
        out = out.limit(limit_rows)
    return out


def jdbc_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str],
    partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 1,
) -> DataFrame:
    """A database table; connection settings come from the caller.

    With a partition column the read is split, so no single task pulls the table.
    """
    if partition_column and bounds:
        return spark.read.jdbc(
            url, table, column=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=partitions, properties=properties,
        )
    return spark.read.jdbc(url, table, properties=properties)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the result; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def table_status(spark: SparkSession, name: str) -> DataFrame:
    """One row: table name, whether it exists, its row count."""
    exists = spark.catalog.tableExists(name)
    rows = (
        spark.table(name).agg(F.count(F.lit(1)).alias("row_count"))
        if exists
        else spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"))
    )
    return rows.select(F.lit(name).alias("table_name"), F.lit(exists).alias("exists"), "row_count")


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
