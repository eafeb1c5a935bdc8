"""Compare Spark results with their SQL on the same tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


TIMES: dict[str, float] = {}

_TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean", "HUGEINT": "HUGEINT!",
}


def compare(spark_df, con, sql: str) -> str:
    """'' when equal, else what differs."""
    clock = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {n: _TYPES.get(str(d[1]), str(d[1])) for n, d in zip(names, cur.description)}
    theirs = rows_of(names, cur.fetchall())
    TIMES["sql"] = time.time() - clock
    clock = time.time()
    ours = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    TIMES["spark"] = time.time() - clock
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    mine = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    bad = {n: (mine[n], types[n]) for n in names if mine[n] != types[n]}
    note = f"types {bad}" if bad else ""
    if len(ours[1]) != len(theirs[1]):
        note += f" rows {len(ours[1])} != {len(theirs[1])}"
    if ours[1] != theirs[1]:
        a, b = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
        note += f" values differ: spark {sorted(a)[:2]} sql {sorted(b)[:2]} ({len(a)}/{len(b)})"
    return note


def main(argv: list[str]) -> int:
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = "/root/testdata/sf" + argv[0]
    wanted = argv[1:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failures = duck(sf), 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            sql = entry.oracle_sql().get(name)
            if sql is None:
                note, n = "", df.count()
                label = f"rows={n}"
            else:
                note = compare(df, con, sql)
                label = f"sql {TIMES['sql']:.1f}s spark {TIMES['spark']:.1f}s"
        except Exception as e:
            note, label = f"{type(e).__name__}: {str(e)[:1500]}", "error"
        failures += bool(note)
        print(f"{'FAIL' if note else 'ok  '} {name} [{label}] {time.time() - start:.1f}s {note[:1800]}", flush=True)
    print("failures", failures)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
