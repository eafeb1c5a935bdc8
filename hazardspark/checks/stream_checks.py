"""Queries over the incremental runs: events land in three parts, a run follows each, and the outputs are read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardspark.checks.base import check, table
from hazardspark.session import fresh_dir
from hazardspark.sinks.keyed import KeyedTable
from hazardspark.streaming import incremental as inc


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose zone-free times are read as UTC."""
    e = table(spark, sf, "events")
    return e.withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))


#: Landings by day of month; rows of a tenth of the ids that end in 7 come with the last one however old they are.
_PARTS = ["day(ts) <= 10 AND event_id % 10 <> 7", "day(ts) BETWEEN 11 AND 20 AND event_id % 10 <> 7", "day(ts) > 20 OR event_id % 10 = 7"]


def _in_three_runs(spark: SparkSession, rows: DataFrame, run: Callable[[DataFrame], None], parts: list[str] | None = None) -> None:
    """Land the parts one after the other; after each, a new run continues from the checkpoint of the one before."""
    land = fresh_dir(spark, "landing")
    for part in parts or _PARTS:
        rows.where(part).write.mode("append").parquet(land)
        run(inc.file_stream(spark, land, rows.schema))


@check("z1_incremental_ingest", "SELECT event_id, user_id, event_type, value FROM events")
def z1(spark, sf):
    out = fresh_dir(spark, "stream")
    _in_three_runs(spark, _events(spark, sf), lambda s: inc.append_run(s, out, f"{out}-state"))
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


@check("z2_stateful_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def z2(spark, sf):
    """Every row lands twice: in its part and with the last one."""
    out = fresh_dir(spark, "stream")
    run = lambda s: inc.dedupe_run(s, ["user_id", "event_type"], "ts", "60 days", out, f"{out}-state")
    _in_three_runs(spark, _events(spark, sf), run, [*_PARTS[:2], "true"])
    return spark.read.parquet(out).select("user_id", "event_type")


_EITHER = """
WITH RECURSIVE e AS (
  SELECT event_id, 'T' || (event_id % 1000) AS title, 'u' || ((event_id * 7) % 1300) AS url,
    row_number() OVER (ORDER BY CASE WHEN event_id % 3 = 2 THEN 1 ELSE 0 END, event_id) AS pos FROM events
), seen AS (
  SELECT 0::BIGINT AS pos, NULL::BIGINT AS event_id, []::VARCHAR[] AS titles, []::VARCHAR[] AS urls
  UNION ALL
  SELECT e.pos, CASE WHEN fresh THEN e.event_id END, CASE WHEN fresh THEN list_append(titles, title) ELSE titles END,
    CASE WHEN fresh THEN list_append(urls, url) ELSE urls END
  FROM (SELECT e.*, s.titles, s.urls, NOT list_contains(s.titles, e.title) AND NOT list_contains(s.urls, e.url) AS fresh
        FROM seen s JOIN e ON e.pos = s.pos + 1) e
) SELECT event_id FROM seen WHERE event_id IS NOT NULL
"""


@check("z2_title_or_url", _EITHER)
def z2b(spark, sf):
    """New title and new url over two landings; the second repeats the first."""
    out = fresh_dir(spark, "stream")
    k = F.col("event_id")
    rows = _events(spark, sf).select(
        "event_id", F.concat(F.lit("T"), (k % 1000).cast("string")).alias("title"), F.concat(F.lit("u"), ((k * 7) % 1300).cast("string")).alias("url")
    )
    run = lambda s: inc.dedupe_either_run(s, "title", "url", "event_id", out, f"{out}-seen", f"{out}-state")
    _in_three_runs(spark, rows, run, ["event_id % 3 <> 2", "event_id % 3 = 2 OR event_id % 2 = 0"])
    return spark.read.parquet(out).select("event_id")


_NEWEST = "arg_max({0}, (ts, event_id)) AS {0}"


@check(
    "z3_incremental_upsert",
    f"SELECT user_id, {_NEWEST.format('event_id')}, {_NEWEST.format('event_type')}, {_NEWEST.format('value')} FROM events GROUP BY user_id",
)
def z3(spark, sf):
    """Newest event of every user; late rows come last and replace nothing."""
    out = fresh_dir(spark, "stream")
    run = lambda s: inc.upsert_run(s, out, "user_id", ["ts", "event_id"], f"{out}-state")
    _in_three_runs(spark, _events(spark, sf), run, ["event_id % 4 < 2", "event_id % 4 = 2", "event_id % 4 = 3 OR day(ts) < 9"])
    return inc.latest(spark, out).select("user_id", "event_id", "event_type", "value")


_LATE = """
WITH p AS (SELECT *, CASE WHEN event_id % 10 = 7 OR day(ts) > 20 THEN 3 WHEN day(ts) <= 10 THEN 1 ELSE 2 END AS part FROM events),
h AS (SELECT part, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM p GROUP BY part)
SELECT event_id, h.high IS NOT NULL AND ts < h.high - INTERVAL 10 DAY AS late FROM p JOIN h USING (part)
"""


@check("z4_late_rows", _LATE)
def z4(spark, sf):
    """Rows older than ten days before the newest of the landings before go to the late output."""
    out = fresh_dir(spark, "stream")
    run = lambda s: inc.late_rows_run(s, "ts", "10 DAYS", f"{out}/kept", f"{out}/late", f"{out}/marks", f"{out}-state")
    _in_three_runs(spark, _events(spark, sf), run)
    read = lambda name: spark.read.parquet(f"{out}/{name}").select("event_id", F.lit(name == "late").alias("late"))
    return read("kept").union(read("late"))


@check("z4_late_counts", f"SELECT count(*) FILTER (NOT late) AS n_kept, count(*) FILTER (late) AS n_late FROM ({_LATE})")
def z4b(spark, sf):
    out = fresh_dir(spark, "stream")
    run = lambda s: inc.late_rows_run(s, "ts", "10 DAYS", f"{out}/kept", f"{out}/late", f"{out}/marks", f"{out}-state")
    _in_three_runs(spark, _events(spark, sf), run)
    return spark.read.parquet(f"{out}/marks").agg(F.sum("n_kept").alias("n_kept"), F.sum("n_late").alias("n_late"))


@check("z5_monthly_counts", "SELECT year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, event_type, count(*) AS ocorrencias FROM events GROUP BY ALL")
def z5(spark, sf):
    """Every event is counted once, also those of open days and those that land late."""
    out = fresh_dir(spark, "stream")
    _in_three_runs(spark, _events(spark, sf), lambda s: inc.day_counts_run(s, "ts", "event_type", out, f"{out}-state"))
    return inc.monthly_from_days(spark.read.parquet(out), "event_type")


@check(
    "k7_bucketed_merge",
    "SELECT o_orderkey AS id, CASE WHEN o_custkey % 50 = 0 THEN 'late' WHEN o_orderkey % 3 = 0 OR o_orderkey % 64 = 2 THEN 'new' ELSE o_orderstatus END AS type, "
    "o_totalprice AS price, o_orderpriority AS note FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 64 = 2 OR o_custkey % 50 = 0",
)
def k7b(spark, sf):
    """Three merges into one keyed table: all of it, some new and known keys, then few keys with repeated rows."""
    o = table(spark, sf, "orders")
    cols = lambda a: [F.col("o_orderkey").alias("id"), a.alias("type"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("note")]
    keyed = KeyedTable(spark, fresh_dir(spark, "keyed"), "id", buckets=32)
    keyed.merge(o.where("o_orderkey % 3 <> 0").select(*cols(F.col("o_orderstatus"))))
    keyed.merge(o.where("o_orderkey % 64 = 2").select(*cols(F.lit("new"))), ["type"])
    last = o.where("o_custkey % 50 = 0").select(*cols(F.lit("late")))
    keyed.merge(last.unionByName(last.withColumn("type", F.lit("early"))), ["type"])
    return keyed.read()
