"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the local cores. The given
tables are single files with one row group, which no scan can divide; they are
first written again as a file per core, outside the timing. Every query runs
once to warm up and is then timed; results are computed in full and thrown
away by the noop sink.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

from hazardspark.checks import QUERIES
from hazardspark.session import build_session

HEADLINES = [
    "flagship_monthly_victims", "news_articles_from_raw", "f17_filter_cascade", "publication_main_table",
    "t1_normalize", "x1_victim_counts", "x2_title_victims", "x4_hazard_type", "x7_place_in_title",
    "x8_relevance_score", "j3_centroid_lookup", "j6_near_duplicate_anti_join", "j10_cross_validation",
    "j13_text_contains_place", "w3_keep_first_content", "k7_upsert", "k8_star_fan_out", "u2_union_of_catalogues",
    "a1_monthly_by_type", "a3_fatalities_by_district", "a14_expand_locations", "m9_annual_allocation",
    "t18_article_text",
]


def dealt(spark, sf_dir: str, cpus: int) -> str:
    """The tables again, with a file for every core where a table has the rows for it."""
    out = tempfile.mkdtemp(prefix="spark-bench-", dir="/tmp")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        table = spark.read.parquet(path)
        table.repartition(cpus if os.path.getsize(path) > 1 << 20 else 1).write.parquet(f"{out}/{os.path.basename(path)}")
    return out


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
            # A small file is a task.
            "spark.sql.files.maxPartitionBytes": "4m", "spark.sql.files.openCostInBytes": "64k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    inputs = dealt(spark, sf_dir, int(cpus))
    times: dict[str, float] = {}
    for name in names:
        laps = []
        for lap in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, inputs).write.format("noop").mode("overwrite").save()
            if lap:
                laps.append(time.perf_counter() - start)
        times[name] = round(statistics.median(laps), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
