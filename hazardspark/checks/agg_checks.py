"""Queries over aggregates, windows, ordering, set operations and forecasting."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardspark.checks import frames as fr
from hazardspark.checks.base import check, table
from hazardspark.checks.extract_checks import ART
from hazardspark.checks.text_checks import calendar_sql
from hazardspark.functions import dates as D
from hazardspark.operators import filters, forecast, report
from hazardspark.plans import dashboard
from hazardspark.schemas import VICTIMS
from hazardspark.sinks import tables as sink_tables
from hazardspark.sources import gazetteer, tables

_KIND = fr.capital_sql("type")
_CLEAN = f"cd AS (SELECT id, {_KIND} AS type, year, month, date FROM dis WHERE {_KIND} IN ('Flood','Landslide'))"
DISC = fr.texts(fr.DIS) + f", {_CLEAN} "


@check("a1_monthly_by_type", DISC + "SELECT year, month, type, make_date(year, month, 1) AS data, count(*) AS ocorrencias FROM cd GROUP BY ALL")
def a1(spark, sf):
    return report.monthly_occurrences(report.clean_disasters(fr.disasters(spark, sf)))


@check("a2_yearly_by_type", DISC + "SELECT year, type, count(*) AS ocorrencias FROM cd GROUP BY ALL")
def a2(spark, sf):
    return report.occurrences(report.clean_disasters(fr.disasters(spark, sf)), "year", "type")


_CLOC = f"cl AS (SELECT *, {fr.title_sql('trim(district)')} AS d FROM loc WHERE latitude IS NOT NULL AND latitude <> -999 AND longitude <> -999)"


@check(
    "a3_fatalities_by_district",
    fr.texts(fr.DIS, fr.IMP, fr.LOC) + f", {_CLEAN}, {_CLOC} SELECT d AS district, type, sum(fatalities)::BIGINT AS fatalities FROM cd JOIN imp USING (id) JOIN cl USING (id) WHERE d <> '' GROUP BY d, type HAVING sum(fatalities) > 0",
)
def a3(spark, sf):
    return dashboard.historical(fr.disasters(spark, sf), fr.impacts(spark, sf), fr.locations(spark, sf))["fatalities"]


_NEWS = (
    f"ne AS (SELECT {fr.title_sql('trim(district)')} AS district, {_KIND} AS type, year, month, latitude, longitude FROM dis JOIN loc USING (id) WHERE latitude IS NOT NULL AND {_KIND} IN ('Flood','Landslide'))"
)
NEWS = fr.texts(fr.DIS, fr.LOC) + f", {_NEWS} "


def _news_events(spark, sf):
    return fr.disasters(spark, sf).select("id", "type", "year", "month").join(fr.locations(spark, sf), "id")


@check("a4_by_district_and_type", NEWS + "SELECT district, type, count(*) AS ocorrencias FROM ne WHERE district <> '' GROUP BY ALL")
def a4(spark, sf):
    return dashboard.recent(_news_events(spark, sf))["by_district"]


@check("a5_district_totals", NEWS + "SELECT district, count(*) AS ocorrencias FROM ne WHERE district <> '' GROUP BY ALL")
def a5(spark, sf):
    return dashboard.recent(_news_events(spark, sf))["district_order"]


@check(
    "a6_bounds",
    fr.texts(fr.IMP) + "SELECT max(fatalities) AS max_value, min(fatalities) AS min_value, round(max(fatalities)*1.1::DOUBLE,4) AS axis_bound FROM imp",
)
def a6(spark, sf):
    return report.bounds(fr.impacts(spark, sf), "fatalities").withColumn("axis_bound", F.round("axis_bound", 4))


@check("a7_yearly_total_by_type", fr.texts(fr.MON) + "SELECT year, type, sum(ocorrencias)::BIGINT AS ocorrencias FROM mon GROUP BY year, type")
def a7(spark, sf):
    return fr.monthly(spark, sf).groupBy("year", "type").agg(F.sum("ocorrencias").alias("ocorrencias"))


@check("a8_mean_point", NEWS + "SELECT district, type, round(avg(latitude),4) AS latitude, round(avg(longitude),4) AS longitude FROM ne GROUP BY ALL")
def a8(spark, sf):
    out = report.mean_point(report.clean_occurrences(_news_events(spark, sf)), "district", "type")
    return out.select("district", "type", F.round("latitude", 4).alias("latitude"), F.round("longitude", 4).alias("longitude"))


_TOT = "+".join(VICTIMS)


@check(
    "a9_run_statistics",
    ART + f"SELECT count(*) AS filtered, count_if({_TOT} > 0)::BIGINT AS with_victims, count_if({_TOT} <= 0)::BIGINT AS without_victims, "
    + ", ".join(f"sum({v})::BIGINT AS total_{v}" for v in VICTIMS)
    + f", round(avg(l_linenumber),2) AS mean_relevance, round(count(*)*100.0::DOUBLE/(SELECT count(*) FROM lineitem),1) AS filter_rate, round(count_if({_TOT} > 0)*100.0::DOUBLE/count(*),1) AS victim_rate FROM (SELECT * REPLACE (CASE WHEN l_tax > 0.05 THEN 0 ELSE fatalities END AS fatalities) FROM art WHERE type IN ('Flood','Landslide'))",
)
def a9(spark, sf):
    a = fr.articles(spark, sf).where(filters.known_hazard(F.col("type"))).withColumns(
        {"fatalities": F.when(F.col("l_tax") > 0.05, 0).otherwise(F.col("fatalities")), "relevance_score": F.col("l_linenumber")}
    )
    loaded = table(spark, sf, "lineitem").agg(F.count(F.lit(1))).scalar()
    return report.run_statistics(a, loaded)


@check(
    "a10_batch_statistics",
    "SELECT count(*) AS combinations, sum(items)::BIGINT AS items, round(avg(items),4) AS items_per_combination, round(count(*)/sum(d),4) AS combinations_per_s FROM (SELECT user_id, event_type, count(*) AS items, sum(value) AS d FROM events GROUP BY ALL)",
)
def a10(spark, sf):
    runs = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("items"), F.sum("value").alias("duration_s"))
    return report.batch_statistics(runs)


@check("a11_table_status", "SELECT 'hazard_orders' AS table_name, true AS \"exists\", count(*) AS row_count FROM orders UNION ALL SELECT 'hazard_missing', false, 0")
def a11(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("hazard_orders")
    return tables.table_status(spark, "hazard_orders").unionByName(tables.table_status(spark, "hazard_missing"))


@check(
    "a12_coordinate_profile",
    fr.texts(fr.LOC) + "SELECT count(*) AS n_rows, count_if(latitude IS NULL)::BIGINT AS null_lat, count_if(longitude IS NULL)::BIGINT AS null_lon, min(latitude) AS min_lat, max(latitude) AS max_lat, min(longitude) AS min_lon, max(longitude) AS max_lon FROM loc",
)
def a12(spark, sf):
    return report.coordinate_profile(fr.locations(spark, sf))


@check("a13_distinct_values", ART + "SELECT DISTINCT district, type FROM art")
def a13(spark, sf):
    return report.distinct_values(fr.articles(spark, sf), "district", "type")


# --- windows ---------------------------------------------------------------------------------


@check("w1_lag_12", fr.texts(fr.MON) + "SELECT year, month, type, ocorrencias, lag(ocorrencias,12) OVER (PARTITION BY type ORDER BY year, month) AS lag_12 FROM mon")
def w1(spark, sf):
    return forecast.with_lag(fr.monthly(spark, sf))


_ROLL = "OVER (PARTITION BY type ORDER BY year, month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"


@check(
    "w2_rolling_6",
    fr.texts(fr.MON) + f"SELECT year, month, type, ocorrencias, round(avg(ocorrencias) {_ROLL},6) AS rolling_mean_6, round(coalesce(stddev_samp(ocorrencias) {_ROLL},0),6) AS rolling_std_6 FROM mon",
)
def w2(spark, sf):
    out = forecast.with_rolling(fr.monthly(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("rolling_mean_6", "rolling_std_6")})


_W4 = "round_even(1000.0::DOUBLE * count / sum(count) OVER (PARTITION BY type), 0)::BIGINT"


@check("w4_share_of_total", ART + f", h AS (SELECT district, type, count(*) AS count FROM art GROUP BY ALL) SELECT district, type, count, {_W4} AS part FROM h")
def w4(spark, sf):
    h = fr.articles(spark, sf).groupBy("district", "type").agg(F.count(F.lit(1)).alias("count"))
    return forecast.share_of_total(h, "type", "count", F.lit(1000.0), "part").select("district", "type", "count", "part")


@check("w5_last_12_rows", fr.texts(fr.MON) + "SELECT * FROM mon QUALIFY row_number() OVER (PARTITION BY type ORDER BY year DESC, month DESC) <= 12")
def w5(spark, sf):
    return forecast.last_rows(fr.monthly(spark, sf))


@check(
    "w7_same_month_profile",
    fr.texts(fr.MON) + "SELECT m.type, m.month, round(avg(ocorrencias),6) AS month_mean, round(coalesce(stddev_samp(ocorrencias),0),6) AS month_std, round(any_value(tm),6) AS type_mean, round(any_value(ts),6) AS type_std "
    "FROM mon m JOIN (SELECT type, avg(ocorrencias) AS tm, stddev_samp(ocorrencias) AS ts FROM mon GROUP BY type) t ON t.type = m.type GROUP BY m.type, m.month",
)
def w7(spark, sf):
    out = forecast.same_month_profile(fr.monthly(spark, sf))
    return out.select("type", "month", *[F.round(c, 6).alias(c) for c in ("month_mean", "month_std", "type_mean", "type_std")])


# --- order, limit, sets ----------------------------------------------------------------------


@check("o1_priority_order")
def o1(spark, sf):
    from hazardspark.checks.ml_checks import relevance_model, relevance_rows
    from hazardspark.operators import relevance

    rows = relevance_rows(spark, sf)
    return relevance.prioritised(rows, relevance_model(spark, sf)).select("doc_id")


@check("o2_top_3", ART + "SELECT district AS evento_nome, count(*) AS n FROM art GROUP BY 1 ORDER BY n DESC, evento_nome LIMIT 3")
def o2(spark, sf):
    return report.top_values(fr.articles(spark, sf).withColumnRenamed("district", "evento_nome"), "evento_nome", 3)


@check("o3_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def o3(spark, sf):
    return tables.query_table(table(spark, sf, "orders"), "o_orderkey, o_totalprice", 25, [F.desc("o_totalprice"), "o_orderkey"])


@check("o4_category_order", NEWS + "SELECT district, count(*) AS ocorrencias, row_number() OVER (ORDER BY count(*) DESC, district)::INTEGER AS position FROM ne WHERE district <> '' GROUP BY district")
def o4(spark, sf):
    from pyspark.sql import Window as W

    totals = dashboard.recent(_news_events(spark, sf))["district_order"]
    # One row per district: the gazetteer bounds the window, not the event table.
    return totals.withColumn("position", F.row_number().over(W.orderBy(F.desc("ocorrencias"), "district")))


@check("o5_first_by_rank", "SELECT o_custkey, arg_min(o_orderkey, (CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 4 END, -o_totalprice, o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def o5(spark, sf):
    from hazardspark.operators.dedupe import keep_first

    o = table(spark, sf, "orders")
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2).otherwise(4)
    o = o.select("o_custkey", "o_orderkey", rank.alias("rank"), (-F.col("o_totalprice")).alias("size"))
    return keep_first(o, ["o_custkey"], ["rank", "size", "o_orderkey"]).select("o_custkey", "o_orderkey")


@check("u1_locality_union", fr.texts(fr.GAZ) + "SELECT localidade, count(*) AS n FROM (SELECT parish AS localidade FROM gaz UNION ALL SELECT municipality FROM gaz UNION ALL SELECT district FROM gaz) GROUP BY 1")
def u1(spark, sf):
    g = fr.gazetteer(spark, sf)
    out = gazetteer.locality_union(g.select("parish"), g.select("municipality"), g.select("district"))
    return out.groupBy("localidade").agg(F.count(F.lit(1)).alias("n"))


@check("u3_priority_blocks", fr.texts(fr.GAZ) + "SELECT CASE keyword WHEN 'neve' THEN 1 ELSE 2 END AS block, keyword, count(*) AS n FROM gaz, (SELECT unnest(['chuva','neve']) AS keyword) GROUP BY ALL")
def u3(spark, sf):
    plan = report.search_plan(["chuva", "neve"], fr.gazetteer(spark, sf).select(F.col("parish").alias("localidade")), days=0)
    return plan.groupBy("block", "keyword").agg(F.count(F.lit(1)).alias("n"))


# --- forecasting -----------------------------------------------------------------------------

_FRAME = fr.texts(fr.MON) + (
    f", f AS (SELECT *, lag(ocorrencias,12) OVER (PARTITION BY type ORDER BY year, month) AS lag_12, avg(ocorrencias) {_ROLL} AS rm FROM mon), g AS (SELECT *, max(year) OVER (PARTITION BY type) AS last FROM f WHERE lag_12 IS NOT NULL) "
)


@check("m4_time_split", _FRAME + "SELECT type, year, month, CASE WHEN year <= last - 2 THEN 'train' ELSE 'test' END AS part, round(rm,6) AS rolling_mean_6 FROM g")
def m4(spark, sf):
    out = forecast.split_by_time(forecast.model_frame(fr.monthly(spark, sf)))
    return out.select("type", "year", "month", "part", F.round("rolling_mean_6", 6).alias("rolling_mean_6"))


@check("m5_regression_forecast")
def m5(spark, sf):
    return forecast.fit_forecast(fr.monthly(spark, sf), 2002)


@check(
    "m6_errors",
    _FRAME + ", p AS (SELECT type, ocorrencias AS y, rm AS p, avg(ocorrencias) OVER (PARTITION BY type) AS m FROM g) SELECT type, round(avg(abs(y-p)),6) AS mae, round(1-sum((y-p)*(y-p))/sum((y-m)*(y-m)),6) AS r2 FROM p GROUP BY type",
)
def m6(spark, sf):
    frame = forecast.model_frame(fr.monthly(spark, sf)).withColumn("prediction", F.col("rolling_mean_6"))
    return forecast.errors(frame).select("type", F.round("mae", 6).alias("mae"), F.round("r2", 6).alias("r2"))


@check(
    "m7_forecast_grid",
    fr.texts(fr.MON) + f", g AS (SELECT type, month, 2002 AS year, (SELECT avg(ocorrencias) FROM mon m WHERE m.type=t.type AND m.month=k.month) AS mm, (SELECT stddev_samp(ocorrencias) FROM mon m WHERE m.type=t.type AND m.month=k.month) AS ms "
    "FROM (SELECT DISTINCT type FROM mon) t, (SELECT unnest(range(1,13))::INTEGER AS month) k) "
    f"SELECT type, year, month, make_date(year,month,1) AS data, {calendar_sql()}, round(mm,6) AS lag_12, round(coalesce(ms,0),6) AS rolling_std_6 FROM g",
)
def m7(spark, sf):
    g = forecast.forecast_grid(fr.monthly(spark, sf), 2002)
    keep = ["type", "year", "month", "data", "trimestre", "estacao_chuvosa", "estacao_seca", "flood_seasonal_risk", "landslide_seasonal_risk", "anos_desde_2000"]
    rounded = [(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("sin_month", "cos_month", "lag_12", "rolling_std_6")]
    return g.select(*keep, *rounded)


@check(
    "m8_interval",
    "SELECT o_orderkey, greatest(1, round_even(p,0)::BIGINT)::BIGINT AS ocorrencias, greatest(0, round_even(greatest(0, p-1.5*e),0)::BIGINT)::BIGINT AS confidence_lower, round_even(p+1.5*e,0)::BIGINT AS confidence_upper FROM "
    "(SELECT o_orderkey, (o_orderkey%41)/2.0::DOUBLE - 3 AS p, (o_orderkey%7)/3.0::DOUBLE AS e FROM orders)",
)
def m8(spark, sf):
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey", ((k % 41) / 2.0 - 3).alias("p"), ((k % 7) / 3.0).alias("e"))
    return o.select("o_orderkey", *[c.alias(n) for n, c in forecast.interval(F.col("p"), F.col("e")).items()])


@check(
    "m9_annual_allocation",
    fr.texts(fr.DIS, fr.LOC) + f", {_NEWS}, mon AS (SELECT {_KIND} AS type, count(*) AS ocorrencias FROM dis GROUP BY 1), c AS (SELECT district, type, count(*) AS count, avg(latitude) AS lat, avg(longitude) AS lon FROM ne WHERE district <> '' GROUP BY ALL) "
    "SELECT c.district, c.type, count, round_even(ocorrencias::DOUBLE*count/sum(count) OVER (PARTITION BY c.type),0)::BIGINT AS predicted_occurrences, round(lat,4) AS latitude, round(lon,4) AS longitude FROM c JOIN mon ON mon.type = c.type",
)
def m9(spark, sf):
    out = forecast.allocate(fr.monthly(spark, sf), report.clean_occurrences(_news_events(spark, sf)))
    return out.select("district", "type", "count", "predicted_occurrences", F.round("latitude", 4).alias("latitude"), F.round("longitude", 4).alias("longitude"))
