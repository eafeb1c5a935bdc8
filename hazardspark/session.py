"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app: str = "hazardspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume.

    On a cluster the submit command names the master, the memory and the
    shuffle width; only the semantics-bearing settings are fixed here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Wide text expressions: generated methods the JVM would not compile are split instead.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Whole pages travel to the HTML helper; small batches bound its memory.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        # The paged source decides equality filters in its readers.
        "spark.sql.python.filterPushdown.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _LOCAL_DIRS[context.applicationId]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder (not created)."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(shared_dir(spark), "checkpoints"))
    return df.checkpoint(eager=True)


def rewritten(df: DataFrame, name: str = "rewritten") -> DataFrame:
    """The rows written as Parquet in the shared folder and read again, for loops that join their own results.

    A checkpoint keeps the size estimate of its plan. Joins multiply estimates, so one that is fed back squares it every
    round, until the driver spends its memory on the digits; a written table has the size of its files.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
