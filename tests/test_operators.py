"""Properties and brute-force comparisons of the set-level operators."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazardspark.operators import catalog, dedupe, filters, forecast, geo, report
from hazardspark.operators.upsert import upsert


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# --- dedupe ----------------------------------------------------------------------------------


def test_title_or_url_equals_sequential_reading(spark):
    rng = random.Random(3)
    data = [(i, f"t{rng.randint(0, 25)}", f"u{rng.randint(0, 25)}?q={i}") for i in range(150)]
    data += [(150 + i, "hot", f"u{i % 40}") for i in range(60)]
    titles, urls, want = set(), set(), []
    for i, title, url in data:
        base = url.split("?")[0]
        if title in titles or base in urls:
            continue
        titles.add(title)
        urls.add(base)
        want.append(i)
    df = spark.createDataFrame(data, "i int, title string, link string").repartition(5)
    got = dedupe.keep_first_title_or_url(df, "title", "link", "i")
    assert [r[0] for r in rows(got, "i")] == want


def near(a, b, tol=1e-5):
    return abs(a[1] - b[1]) < tol and abs(a[2] - b[2]) < tol


def test_near_repeats_equal_sequential_reading(spark):
    rng = random.Random(5)
    # Chains, clusters around one spot, exact copies.
    data = [(i, 40 + rng.randint(0, 30) * 3e-6, -8 + rng.randint(0, 30) * 3e-6, "k") for i in range(120)]
    data += [(120 + i, 40 + i * 0.6e-5, -9.0, "chain") for i in range(20)]
    data += [(140 + i, 41.0, -9.0, "same") for i in range(50)]
    want, kept = [], []
    for row in data:
        if any(row[3] == k[3] and near(row, k) for k in kept):
            continue
        kept.append(row)
        want.append(row[0])
    df = spark.createDataFrame(data, "i int, lat double, lon double, k string").repartition(4)
    got = dedupe.drop_near_repeats(df, ["k"], "lat", "lon", "i")
    assert [r[0] for r in rows(got, "i")] == want


def test_near_repeats_keeps_rows_without_key_or_point(spark):
    df = spark.createDataFrame([(1, None, 1.0, "k"), (2, 1.0, 1.0, None), (3, 1.0, 1.0, None)], "i int, lat double, lon double, k string")
    assert rows(dedupe.drop_near_repeats(df, ["k"], "lat", "lon", "i"), "i") == [(1,), (2,), (3,)]


def test_near_matches_brute_force(spark):
    rng = random.Random(9)
    point = lambda: (40 + rng.randint(0, 60) * 4e-6, -8 + rng.randint(0, 60) * 4e-6, rng.choice("ab"))
    left = [(i, *point()) for i in range(150)]
    right = [(i, *point()) for i in range(60)]
    want = [l[0] for l in left if not any(l[3] == r[3] and near(l, r) for r in right)]
    schema = "i int, lat double, lon double, k string"
    got = dedupe.drop_near_matches(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], "lat", "lon")
    assert [r[0] for r in rows(got, "i")] == want


def test_keep_first_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a")], "i int, k string")
    assert rows(dedupe.keep_first(df, ["k"], ["i"]), "i") == [(1,), (3,)]
    assert rows(dedupe.keep_last(df, ["k"], ["i"]), "i") == [(2,), (4,)]


# --- upsert ----------------------------------------------------------------------------------


def test_upsert_is_idempotent_and_updates_named_columns(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, s string")
    s = spark.createDataFrame([("b", 9, "new"), ("c", 3, "z"), ("c", 4, "w")], "id string, n int, s string").withColumn("load", F.col("n"))
    once = upsert(t, s, "id", ["n"], order=["load"])
    assert rows(once, "id", "n", "s") == [("a", 1, "x"), ("b", 9, "y"), ("c", 4, "w")]
    assert rows(upsert(once, s, "id", ["n"], order=["load"]), "id", "n", "s") == rows(once, "id", "n", "s")


def test_upsert_can_write_null(spark):
    t = spark.createDataFrame([("a", 1)], "id string, n int")
    s = spark.createDataFrame([("a", None)], "id string, n int")
    assert rows(upsert(t, s, "id"), "id", "n") == [("a", None)]


# --- catalogue -------------------------------------------------------------------------------


@settings(max_examples=8, deadline=None)
@given(total=st.integers(0, 500), names=st.lists(st.sampled_from(["Loures", "Faro", "Oeste (x)", "Loure", " "]), min_size=1, max_size=5))
def test_expansion_preserves_sums(spark, total, names):
    df = spark.createDataFrame([(", ".join(names), float(total), None, 3.0)], "Location string, `Total Deaths` double, `No. Injured` double, `No. Homeless` double")
    got = catalog.expand_locations(df).collect()
    parts = [n for n in names if n.strip()]
    assert len(got) == len(parts)
    if parts:
        assert sum(r["split_deaths"] for r in got) == total
        shares = [r["split_deaths"] for r in got]
        assert shares == sorted(shares, reverse=True) and shares[0] - shares[-1] <= 1


def test_expansion_example(spark):
    df = spark.createDataFrame([("Loures, Faro and Oeste (x)", 5.0, 0.0, 0.0)], "Location string, `Total Deaths` double, `No. Injured` double, `No. Homeless` double")
    assert [(r["Location"], r["split_deaths"]) for r in catalog.expand_locations(df).collect()] == [("Loures", 2), ("Faro", 2), ("Oeste", 1)]


def test_event_ids_are_stable_and_unique(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "s string, n int")
    first, second = catalog.with_event_id(df.repartition(3)), catalog.with_event_id(df.coalesce(1))
    assert rows(first, "id") == rows(second, "id")
    assert first.select("id").distinct().count() == 3


def test_event_ids_of_many_copies(spark, monkeypatch):
    monkeypatch.setattr(catalog, "COPIES_PER_TASK_ROW", 10)
    df = spark.range(57).select((F.col("id") % 2 * 0).alias("a")).unionByName(spark.range(3).select(F.col("id").alias("a")))
    got = catalog.with_event_id(df)
    assert (got.count(), got.select("id").distinct().count(), got.where("a = 0").count()) == (60, 60, 58)


# --- filters ---------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "date, want",
    [(None, True), ("x", True), ("2024-06-01", True), ("01/06/2024", True), ("2023-06-02", True), ("2023-05-31", False), ("2024-06-02", False), ("2024-05-31 12:00:00", True), ("2024-06-01 00:00:01", False)],
)
def test_recent(one, date, want):
    assert one(lambda c: filters.is_recent(c, "2024-06-01"), date) is want


def test_victims_plausible(spark):
    data = [(1, 10001, 0), (2, 6000, 6000), (3, 0, 0), (4, -5, 1), (5, 10000, 0), (6, None, 2)]
    df = spark.createDataFrame(data, "i int, fatalities int, injured int").selectExpr("*", "0 evacuated", "0 displaced", "0 missing")
    assert rows(df.where(filters.victims_plausible()), "i") == [(4,), (5,), (6,)]


def test_cascade_does_not_depend_on_partitioning(spark):
    from hazardspark.checks import frames as fr
    from hazardspark.schemas import ARTICLE

    sf = "/root/testdata/sf0.001"
    a = fr.articles(spark, sf).select("seq", *ARTICLE.fieldNames())
    d, p = fr.valid_districts(spark, sf), fr.valid_parishes(spark, sf)
    run = lambda x: rows(filters.cascade(x, d, p, "2001-08-01", ["seq"], 2000), "seq", "relevance_score", "evento_nome")
    whole, many = run(a.coalesce(1)), run(a.repartition(7))
    assert whole == many and whole


# --- georeferencing --------------------------------------------------------------------------


def test_places_in_text_equals_substring_search(spark):
    rng = random.Random(11)
    names = ["Faro", "São", "a", "Vila Real", "Real", "lá", "Évora", "Vila Nova de Gaia", "ova", "--"]
    texts = [" ".join(rng.choice(["Vila", "Real", "Nova de Gaia", "evora", "SAO", "farol", "xx", "--"]) for _ in range(6)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    places = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "rank int, name string")
    import unicodedata

    fold = lambda s: unicodedata.normalize("NFKD", s.lower()).encode("ascii", "ignore").decode().strip()
    want = sorted((i, n) for i, t in enumerate(texts) for n in names if fold(n) in fold(t))
    assert rows(geo.places_in_text(docs, "id", "text", places, "name", "rank"), "id", "place") == want


@pytest.mark.parametrize("bound", [0, 1 << 60])
def test_places_do_not_depend_on_the_gazetteer_size(spark, tmp_path, monkeypatch, bound):
    """Null and repeated ids, at a bound below and above the size of a gazetteer that is read from a file."""
    monkeypatch.setattr(geo, "SMALL_GAZETTEER_BYTES", bound)
    docs = spark.createDataFrame(
        [("d", "porto lisboa"), ("d", "porto braga"), ("d", "porto braga"), (None, "porto"), (None, None), ("e", "x" * 300 + " Braga")], "id string, text string"
    )
    spark.createDataFrame([(1, "Lisboa"), (2, "Porto"), (3, "Braga")], "rank int, name string").write.parquet(str(tmp_path / "g"))
    places = spark.read.parquet(str(tmp_path / "g"))
    got = sorted((r["id"] or "", r["place"]) for r in geo.places_in_text(docs, "id", "text", places, "name", "rank").collect())
    assert got == [("", "Porto"), ("d", "Braga"), ("d", "Lisboa"), ("d", "Porto"), ("d", "Porto"), ("e", "Braga")]
    first = sorted((r["id"] or "", r["text"] or "", r["place"] or "") for r in geo.first_place_in_text(docs, "id", "text", places, "name", "rank").collect())
    assert first == [
        ("", "", ""), ("", "porto", "Porto"), ("d", "porto braga", "Porto"), ("d", "porto braga", "Porto"), ("d", "porto lisboa", "Lisboa"), ("e", "x" * 300 + " Braga", "Braga"),
    ]


def test_null_order_loses_but_keeps_its_key(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", None, 2), ("b", 5, 3), ("c", 4, 4), ("c", 9, 5)], "k string, o int, v int")
    assert rows(dedupe.keep_first(df, ["k"], ["o"]), "k", "v") == [("a", 1), ("b", 3), ("c", 4)]
    assert rows(dedupe.keep_last(df, ["k"], ["o"]), "k", "v") == [("a", 1), ("b", 3), ("c", 5)]


def test_upsert_without_order_keeps_keys_unique(spark):
    target = spark.createDataFrame([("a", 1)], "id string, n int")
    source = spark.createDataFrame([("a", 2), ("a", 3), ("b", 4), ("b", 5), (None, 6)], "id string, n int")
    assert rows(upsert(target, source, "id"), "id", "n") == [("a", 3), ("b", 5)]


def test_event_ids_tell_nulls_and_separators_apart(spark):
    df = spark.createDataFrame([("x", None), ("x", ""), ("a|b", "c"), ("a", "b|c"), ("-", None), (None, "-")], "p string, q string")
    assert catalog.with_event_id(df).select("id").distinct().count() == 6


def test_an_unreadable_report_takes_no_others_with_it(spark):
    df = spark.createDataFrame([("1", "38.5"), ("2", "n/a"), ("3", None)], "type string, latitude string")
    good, bad = catalog.report_quarantine(df)
    assert rows(good, "type") == [("1",), ("3",)] and rows(bad, "type") == [("2",)]
    assert rows(catalog.report_events(df), "type", "latitude") == [("1", 38.5), ("2", 0.0), ("3", 0.0)]


def test_locate_prefers_the_most_precise_level(spark):
    c = spark.createDataFrame(
        [(1.0, 1.0, "D", "M", "P", "2"), (9.0, 9.0, "D", "M", "P", "1"), (2.0, 2.0, "D", "M", None, "3"), (3.0, 3.0, "D", None, None, "4")],
        "latitude double, longitude double, distrito string, concelho string, freguesia string, dicofre string",
    )
    e = spark.createDataFrame(
        [(1, " p ", "m", "d"), (2, "?", "M", "d"), (3, None, "?", "D"), (4, "?", "?", "?")], "i int, parish string, municipality string, district string"
    ).selectExpr("*", "CAST(NULL AS double) latitude", "CAST(NULL AS double) longitude", "'unknown' georef_class")
    got = rows(geo.locate(e, c), "i", "latitude", "georef_class")
    assert got == [(1, 9.0, "freguesia"), (2, 9.0, "concelho"), (3, 9.0, "distrito"), (4, None, "unknown")]


# --- reports and forecasting -----------------------------------------------------------------


def test_confirmed_share_brute_force(spark):
    rng = random.Random(2)
    day = lambda: f"2025-01-{rng.randint(1, 28):02d}"
    a = [(i, rng.choice("xy"), day(), rng.randint(0, 3)) for i in range(80)]
    b = [(i, rng.choice("xy"), day(), rng.randint(0, 3)) for i in range(25)]
    gap = lambda p, q: abs(int(p[-2:]) - int(q[-2:]))
    want = sorted((i, any(d == e and v == w and gap(t, u) <= 2 for _, e, u, w in b)) for i, d, t, v in a)
    make = lambda data: spark.createDataFrame(data, "i int, district string, date string, victims int").withColumn("date", F.to_date("date"))
    assert rows(report.confirmed_share(make(a), make(b)), "i", "confirmed") == want


def test_search_plan_front_share(spark):
    places = spark.createDataFrame([(f"p{i}",) for i in range(101)], "localidade string")
    plan = report.search_plan(["chuva", "cheias"], places, days=3)
    counts = {r["block"]: r["count"] for r in plan.groupBy("block").count().collect()}
    assert counts == {0: 30, 1: 101, 2: 71}


def test_rolling_of_a_single_row(spark):
    df = spark.createDataFrame([(2020, 1, "Flood", 4)], "year int, month int, type string, ocorrencias int")
    r = forecast.with_rolling(df).first()
    assert (r["rolling_mean_6"], r["rolling_std_6"]) == (4.0, 0.0)


def test_forecast_ranges(spark):
    from hazardspark.checks import frames as fr

    out = forecast.fit_forecast(fr.monthly(spark, "/root/testdata/sf0.001"), 2002, trees=10)
    got = out.collect()
    assert len(got) == 36 and {r["month"] for r in got} == set(range(1, 13))
    assert all(r["ocorrencias"] >= 1 and 0 <= r["confidence_lower"] <= r["confidence_upper"] and r["model_mae"] >= 0 for r in got)
