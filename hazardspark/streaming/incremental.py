"""Incremental form of the daily runs, as ``availableNow`` streams.

Each function starts and finishes one run; state and output live below folders the caller names, so a run restarted
after a failure continues where it stopped, and a repeated micro-batch writes the same files again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hazardspark.operators.dedupe import keep_first_title_or_url, title_and_url
from hazardspark.session import cut_lineage
from hazardspark.sinks.keyed import KeyedTable

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None) -> DataFrame:
    """New Parquet files of a folder."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def _run(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append_run(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Ingest what is new and append it."""
    _run(stream.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint)


# --- de-duplication --------------------------------------------------------------------------


def dedupe_run(stream: DataFrame, keys: list[str], time: str, delay: str, out: str, checkpoint: str) -> None:
    """Append rows whose keys were not seen within the watermark delay."""
    append_run(stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys), out, checkpoint)


def dedupe_either_run(stream: DataFrame, title: str, url: str, order: str, out: str, seen: str, checkpoint: str, buckets: int = 64) -> None:
    """Append rows whose title and base url are both new, in this micro-batch (read in ``order``) and in all before.

    No single key says whether a row is new, so what was seen is two tables of keys below ``seen``; a batch reads and
    rewrites only the buckets its own keys fall into. A row that is rejected registers neither key.
    """
    spark = stream.sparkSession
    tables = {name: KeyedTable(spark, f"{seen}/{name}", name, buckets) for name in ("_title", "_url")}

    def admit(batch: DataFrame, batch_id: int) -> None:
        rows = cut_lineage(title_and_url(batch, title, url))
        for name, table in tables.items():
            # What this very batch registered before a failure does not count.
            known = table.near(rows.where(F.col(name).isNotNull()), below=batch_id)
            if known is not None:
                rows = rows.join(known.select(name), name, "left_anti")
        kept = cut_lineage(keep_first_title_or_url(rows.select(*batch.columns), title, url, order))
        kept.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        for name, table in tables.items():
            table.merge(title_and_url(kept, title, url).select(name).distinct(), version=batch_id)

    _run(stream.writeStream.foreachBatch(admit), checkpoint)


# --- newest row per key ----------------------------------------------------------------------


class NewestRow(StatefulProcessor):
    """Keeps the order of a key's newest row and passes a row on only if it is not older.

    Behind the row's own ``columns`` come those of its order and, where keys expire, its event time in milliseconds.
    Columns are taken by their place: names with an underscore arrive changed. A timer drops the state of a key when the
    watermark is ``idle_ms`` past its newest row.
    """

    def __init__(self, columns: list[str], schema: T.StructType, idle_ms: int | None):
        self.columns, self.schema, self.idle_ms = columns, schema, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.schema)

    @staticmethod
    def _rank(values: tuple) -> tuple:
        """Nulls (and pandas' NaN and NaT) are below everything."""
        return tuple((0, 0) if v is None or v != v else (1, v) for v in values)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        best, row, seen, own = None, None, 0, len(self.columns)
        until = own + len(self.schema)
        for part in rows:
            ranks = [self._rank(v) for v in part.iloc[:, own:until].itertuples(index=False, name=None)]
            at = max(range(len(ranks)), key=ranks.__getitem__)
            if best is None or ranks[at] >= best:
                best, row = ranks[at], part.iloc[[at], :own]
                seen = int(part.iloc[at, until]) if self.idle_ms is not None else 0
        if best is None or self.newest.exists() and best < self._rank(tuple(self.newest.get())):
            return
        self.newest.update(tuple(None if not some else v for some, v in best))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(seen + self.idle_ms)
        yield row.set_axis(self.columns, axis=1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        self.newest.clear()
        return iter([])

    def close(self) -> None:
        pass


def _orderable(df: DataFrame, column: str) -> Column:
    """A column as a double or as text of the same order, which pandas and the state keep exactly.

    Whole numbers become text of one length: pandas turns longs beside nulls into doubles.
    """
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif not isinstance(kind, T.IntegralType):
        return c.cast("double" if isinstance(kind, T.NumericType) else "string")
    wide = c.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    return F.lpad(wide.cast("string"), 20, "0")


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def newest_rows(stream: DataFrame, key: str, order: list[str], time: str | None = None, idle_days: int | None = None) -> DataFrame:
    """Rows that are not older than what the stream has had of their key, one per key and micro-batch.

    The state has the order of one row per key. With ``time`` and ``idle_days`` a key's state goes when the watermark
    (of as many days) has passed its newest row; rows without a time or behind the watermark then take no part.
    """
    ready = stream.withColumns({f"_o{i}": _orderable(stream, c) for i, c in enumerate(order)})
    schema = T.StructType([ready.schema[f"_o{i}"] for i in range(len(order))])
    if idle_days is None:
        return ready.groupBy(key).transformWithStateInPandas(NewestRow(stream.columns, schema, None), stream.schema, "Update", "none")
    ready = ready.where(F.col(time).isNotNull()).withWatermark(time, f"{idle_days} days").withColumn("_at", F.unix_millis(time))
    processor = NewestRow(stream.columns, schema, idle_days * 86_400_000)
    return ready.groupBy(key).transformWithStateInPandas(processor, stream.schema, "Update", "eventTime")


def upsert_run(
    stream: DataFrame, table: str, key: str, order: list[str], checkpoint: str,
    update_cols: list[str] | None = None, keep: int = 2, buckets: int = 64,
    time: str | None = None, idle_days: int | None = None,
) -> None:
    """Merge every micro-batch's newest rows into a keyed table; buckets without such rows are not touched.

    Rows older than their key's newest stop at the stateful operator. Where its state has expired, or was lost with the
    checkpoint, the table's own order columns still keep an older row from replacing a newer one.
    """
    spark = stream.sparkSession
    target = KeyedTable(spark, table, key, buckets)

    def merge(batch: DataFrame, batch_id: int) -> None:
        target.merge(batch, update_cols, order, version=batch_id, keep=keep)

    with _rocksdb(spark):
        _run(newest_rows(stream, key, order, time, idle_days).writeStream.outputMode("update").foreachBatch(merge), checkpoint)


def latest(spark: SparkSession, table: str, key: str = "key") -> DataFrame | None:
    """Newest version of a table that ``upsert_run`` keeps."""
    return KeyedTable(spark, table, key).read()


# --- late rows -------------------------------------------------------------------------------


def within_window(df: DataFrame, time: str, as_of: Column, days: int) -> DataFrame:
    """Rows at most ``days`` old."""
    return df.where(F.to_date(time).between(F.date_sub(as_of, days), as_of))


def late_rows_run(stream: DataFrame, time: str, delay: str, kept: str, late: str, marks: str, checkpoint: str) -> None:
    """Append rows to ``kept``, or to ``late`` if they are older than the watermark; rows without a time are late.

    The watermark is the greatest time of all micro-batches before, less ``delay`` (an interval). Spark's own watermark
    drops late rows inside stateful operators and keeps only their number, so it is held here as one row per batch in
    ``marks``, with the counts of the batch; a repeated batch finds the same marks.
    """
    spark = stream.sparkSession
    schema = "batch long, high timestamp, n_kept long, n_late long"

    def route(batch: DataFrame, batch_id: int) -> None:
        before = high_mark(spark, marks, batch_id)
        rows = cut_lineage(batch)
        limit = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        at = F.col(time).cast("timestamp")
        fresh = at.isNotNull() if before is None else F.coalesce(at >= limit, F.lit(False))
        rows.where(fresh).write.mode("overwrite").parquet(f"{kept}/batch={batch_id}")
        rows.where(~fresh).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
        mark = rows.agg(
            F.lit(batch_id).cast("long").alias("batch"), F.greatest(F.max(at), F.lit(before).cast("timestamp")).alias("high"),
            F.count_if(fresh).alias("n_kept"), F.count_if(~fresh).alias("n_late"),
        )
        mark.select(*[f.split()[0] for f in schema.split(", ")]).write.mode("overwrite").parquet(f"{marks}/v={batch_id:09d}")

    _run(stream.writeStream.foreachBatch(route), checkpoint)


def high_mark(spark: SparkSession, marks: str, below: int):
    """Greatest time seen in the micro-batches below a number, or None."""
    path = spark._jvm.org.apache.hadoop.fs.Path(marks)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.parquet(marks).where(F.col("batch") < below).agg(F.max("high")).first()[0]


# --- counts ----------------------------------------------------------------------------------


def daily_counts_run(stream: DataFrame, time: str, kind: str, delay: str, out: str, checkpoint: str) -> None:
    """Append the counts per UTC day and kind once the watermark has closed the day.

    Days are fixed-length windows and bounded state. A day that is still open is in the state only; rows that come
    after their day was closed are dropped, so no appended row ever changes.
    """
    daily = (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, "1 day"), kind)
        .agg(F.count(F.lit(1)).alias("ocorrencias"))
        .select(F.to_date(F.to_utc_timestamp("window.start", F.current_timezone())).alias("day"), kind, "ocorrencias")
    )
    append_run(daily, out, checkpoint)


def day_counts_run(stream: DataFrame, time: str, kind: str, out: str, checkpoint: str) -> None:
    """Append what every micro-batch adds to the counts per UTC day and kind: open days and late rows are counted too.

    A day may have rows of many batches, which a reader adds up. No state is held, so no row is too late; a repeated
    batch writes its folder again. Rows without a time are counted without a day.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        day = F.to_date(F.to_utc_timestamp(time, F.current_timezone())).alias("day")
        counts = batch.groupBy(day, kind).agg(F.count(F.lit(1)).alias("ocorrencias"))
        counts.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run(stream.writeStream.foreachBatch(add), checkpoint)


def monthly_from_days(days: DataFrame, kind: str) -> DataFrame:
    return days.groupBy(F.year("day").alias("year"), F.month("day").alias("month"), kind).agg(
        F.sum("ocorrencias").alias("ocorrencias")
    )
