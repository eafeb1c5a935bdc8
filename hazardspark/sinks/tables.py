"""Typed staging, centroid load and run records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from hazardspark import schemas
from hazardspark.functions import dates as D
from hazardspark.functions import text as T

_TEXT = {"title", "snippet", "source", "page", "district", "parish", "evento_nome"}


def staging_name(day: str | dt.date) -> str:
    return f"artigos_filtrados_{str(day).replace('-', '')}_staging"


def staging_frame(df: DataFrame, stamp: Column, numeric_codes: bool = False) -> DataFrame:
    """Typed staging rows.

    The id comes from original_id, google_id, ID or id; dates become DD/MM/YYYY
    and rows without one go; counts default to 0; 'nan' and 'None' are missing.
    Types follow the column names. Parish codes stay text, so that ``010101``
    still meets the centroids; ``numeric_codes`` makes them floats.
    """
    out = df
    source_id = next((c for c in ("original_id", "google_id", "ID", "id") if c in df.columns), None)
    if source_id and source_id != "ID":
        # A column that differs only in case would be ambiguous: replace it.
        out = out.withColumn("ID", F.col(source_id)) if source_id != "id" else out.withColumnRenamed("id", "ID")
    if "date" in out.columns:
        out = out.withColumn("date", D.to_dmy_text(F.col("date"))).where(F.col("date").isNotNull())
    typed = {}
    for field in out.schema.fields:
        name, kind = field.name, schemas.staging_type(field.name, numeric_codes)
        col = F.col(f"`{name}`")
        if isinstance(field.dataType, T_.ArrayType):
            typed[name] = F.array_join(col, ",")
        elif isinstance(kind, T_.IntegerType):
            typed[name] = T.to_count(col)
        elif name == "relevance_score":
            typed[name] = F.coalesce(T.to_number(col), F.lit(0.0)).cast("float")
        elif isinstance(kind, T_.FloatType):
            typed[name] = T.to_number(col).cast("float")
        elif name in _TEXT:
            typed[name] = T.clean_token(col.cast("string"))
        else:
            typed[name] = F.when(~col.cast("string").isin("nan", "None"), col.cast("string"))
    return out.select(
        *[c.alias(n) for n, c in typed.items()], stamp.alias("created_at"), stamp.alias("updated_at")
    )


def located_only(df: DataFrame) -> DataFrame:
    """Rows with both coordinates."""
    return df.dropna(subset=["latitude", "longitude"])


def load(df: DataFrame, path: str, if_exists: str = "replace") -> None:
    """Replace or append, rows without coordinates left out."""
    modes = {"replace": "overwrite", "append": "append", "fail": "error"}
    located_only(df).write.mode(modes[if_exists]).parquet(path)


def run_record(
    exported: DataFrame, table_name: str, input_rows: int | Column, run_date: str | dt.date, stamp: Column
) -> DataFrame:
    """One row of run statistics; the status follows from the counts."""
    rows = F.count(F.lit(1))
    loaded = input_rows if isinstance(input_rows, Column) else F.lit(input_rows).cast("bigint")
    return exported.agg(
        F.lit(table_name).alias("table_name"),
        F.when(loaded == 0, "sem_dados_disponiveis").when(rows == 0, "falhado").otherwise("sucesso").alias("status"),
        loaded.alias("input_rows"),
        rows.alias("exported_rows"),
        F.to_date(F.lit(str(run_date))).alias("run_date"),
        stamp.alias("recorded_at"),
    )
