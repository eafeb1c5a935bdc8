"""Counts of the cascade move the columns that tell rows apart, and stay right where a stage leaves nothing."""

import itertools

from pyspark.sql import functions as F

from hazardspark.checks import filter_checks as fc
from hazardspark.operators import dedupe, filters
from hazardspark.schemas import VICTIMS

AS_OF = "2001-08-01"
SCHEMA = "ID string, page string, title string, district string, parish string, date string, fatalities string, injured int"


def _numbers(df):
    return [r["n_rows"] for r in df.orderBy("stage_no").collect()]


def _articles(spark):
    pages = ["https://www.publico.pt/cheia-mortos-{}/", "https://www.publico.pt/cheia-rapida-mortos-{}", "https://www.publico.br/brasil/cheia-mortos-{}", None]
    places = [("Lisboa", "Sintra"), ("LISBOA ", ""), ("Lisboa", None), ("Nowhere", "Sintra"), (None, "Sintra"), ("Lisboa", "Elsewhere")]
    dates, deaths = ["2001-07-30", "1990-01-01", None], ["2", "x", "0", "99999"]
    rows = [
        (f"{i:04d}", page and page.format(i // 7), f"Cheia rápida com mortos {i % 5}", d, p, day, n, i % 2)
        for i, (page, (d, p), day, n) in enumerate(itertools.product(pages, places, dates, deaths))
    ]
    return spark.createDataFrame([*rows, ("9999", rows[0][1], None, "Lisboa", "", None, None, None)], SCHEMA)


def _one_by_one(df, districts, parishes):
    """The stages one after the other, each as its own filter."""
    out = filters._prepared(df)
    counts = [out.count()]
    kept = filters.geographic(out, districts, parishes)
    kept = kept.withColumn("_url", F.lower(F.coalesce("page", F.lit(""))))
    counts.append(kept.count())
    for _, test in filters._row_stages(AS_OF, 365)[:-1]:
        kept = kept.where(test)
        counts.append(kept.count())
    kept = filters._scored(kept).where(filters._row_stages(AS_OF, 365)[-1][1])
    counts.append(kept.count())
    kept = dedupe.keep_first(kept, ["page"], ["ID"])
    counts.append(kept.count())
    content = dedupe.content_keys(df)
    return [*counts, kept.groupBy(*content).count().count() if content else counts[-1]]


def test_counts_are_those_of_the_stages_one_by_one(spark):
    a = _articles(spark)
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    d, p = names("Lisboa", "Porto"), names("Sintra", "Sintra")
    got = _numbers(filters.cascade_counts(a, d, p, AS_OF, ["ID"]))
    assert got == _one_by_one(a, d, p) and got[0] == 289 and got[-1] > 1 and got[-1] < got[-3]
    # Nothing known, nothing home, nothing at all, nothing recent; fewer columns that tell contents apart.
    bare = a.drop("date", "fatalities", "injured")
    for df, dd, pp in ((a, names(), p), (a, d, names()), (a.where("page like '%brasil%'"), d, p), (a.limit(0), d, p), (a.where("date < '1999'"), d, p), (bare, d, p)):
        full = df if "date" in df.columns else df.withColumn("date", F.lit(None).cast("string"))
        assert _numbers(filters.cascade_counts(full, dd, pp, AS_OF, ["ID"])) == _one_by_one(full, dd, pp)


def test_counts_come_the_same_with_the_rows(spark):
    a, d, p = _articles(spark), *[spark.createDataFrame([(x,)], "name string") for x in ("Lisboa", "Sintra")]
    rows, counts = filters.observed_cascade(a, d, p, AS_OF, ["ID"])
    got = {r["ID"]: r for r in rows.collect()}
    want = {r["ID"]: r for r in filters.cascade(a, d, p, AS_OF, ["ID"]).collect()}
    same = ["page", "title", "district", "parish", "date", "fatalities", "injured", "relevance_score", "matched_categories", "evento_nome"]
    assert got and {k: [r[c] for c in same] for k, r in got.items()} == {k: [r[c] for c in same] for k, r in want.items()}
    assert _numbers(counts()) == _numbers(filters.cascade_counts(a, d, p, AS_OF, ["ID"]))


def test_counts_move_only_columns_that_tell_rows_apart(spark, monkeypatch):
    moved, keep = [], dedupe.keep_first
    monkeypatch.setattr(filters.dedupe, "keep_first", lambda df, *a: moved.append(df.columns) or keep(df, *a))
    a, d, p = fc._cascade_args(spark, "/root/testdata/sf0.001")
    filters.cascade_counts(a, d, p, fc.AS_OF, ["seq"], fc.MAX_AGE)
    assert moved and set(itertools.chain(*moved)) == {"seq", "page", "district", "parish", "date", *VICTIMS[:2]}
