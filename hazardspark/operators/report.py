"""Aggregates and joins behind the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardspark import vocab
from hazardspark.functions import dates as D
from hazardspark.functions import extract as X
from hazardspark.functions import text as T
from hazardspark.operators import filters
from hazardspark.schemas import VICTIMS


def occurrences(df: DataFrame, *keys: str) -> DataFrame:
    """Row count per key; rows with a missing key do not form a group."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("ocorrencias"))


def monthly_occurrences(df: DataFrame) -> DataFrame:
    """Per (year, month, type), with the first day of the month."""
    return occurrences(df, "year", "month", "type").withColumn(
        "data", D.month_start(F.col("year"), F.col("month"))
    )


def clean_disasters(df: DataFrame) -> DataFrame:
    """Capitalised type, floods and landslides only, complete dates."""
    return (
        df.withColumn("type", T.capitalize(F.col("type")))
        .where(filters.known_hazard(F.col("type")))
        .dropna(subset=["year", "month", "date"])
    )


def clean_occurrences(df: DataFrame) -> DataFrame:
    """The same for published news events, which need coordinates instead of a date."""
    return (
        df.withColumn("type", T.capitalize(F.col("type")))
        .where(filters.known_hazard(F.col("type")))
        .dropna(subset=["year", "month", "latitude", "longitude"])
        .withColumn("district", T.canonical_district(F.col("district")))
    )


def clean_locations(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Valid coordinates and canonical district names."""
    return df.where(filters.valid_coordinates(F.col("latitude"), F.col("longitude"))).withColumn(
        "district", T.canonical_district(F.col("district"), aliases)
    )


def with_impacts(disasters: DataFrame, impacts: DataFrame, locations: DataFrame) -> DataFrame:
    """Disasters with fatalities and district (left joins on the unique id)."""
    return (
        disasters.join(impacts.select("id", "fatalities"), "id", "left")
        .join(locations.select("id", "district"), "id", "left")
        .withColumn("fatalities", F.coalesce("fatalities", F.lit(0)))
    )


def mapped(disasters: DataFrame, locations: DataFrame) -> DataFrame:
    """Disasters that have a location (inner join on the unique id)."""
    place = lambda c: T.title_case(T.strip(F.coalesce(F.col(c), F.lit(vocab.UNKNOWN_DISTRICT))))
    return disasters.join(
        locations.select("id", "latitude", "longitude", "district", "municipality"), "id"
    ).withColumns({"district": T.canonical_district(place("district")), "municipality": place("municipality")})


def fatalities_by_district(df: DataFrame) -> DataFrame:
    """Fatalities per (district, type), groups above 0."""
    return (
        df.where(filters.named_district(F.col("district")))
        .groupBy("district", "type")
        .agg(F.sum("fatalities").alias("fatalities"))
        .where(F.col("fatalities") > 0)
    )


def ranked_totals(df: DataFrame, key: str, value: str) -> DataFrame:
    """Totals per key, largest first."""
    return df.groupBy(key).agg(F.sum(value).alias(value)).orderBy(F.desc(value), key)


def bounds(df: DataFrame, value: str, margin: float = 1.1) -> DataFrame:
    """Largest and smallest value and an axis bound above the largest."""
    return df.agg(
        F.max(value).alias("max_value"), F.min(value).alias("min_value"),
        (F.max(value) * F.lit(margin)).alias("axis_bound"),
    )


def mean_point(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")
    )


def run_statistics(filtered: DataFrame, loaded: Column) -> DataFrame:
    """One row: counts, victim totals, mean relevance, filter and victim rate in percent."""
    n = F.count(F.lit(1))
    victims = F.count_if(filters.victim_total() > 0)
    pct = lambda a, b: F.round(F.try_divide(a * F.lit(100.0), b), 1)
    return filtered.agg(
        n.alias("filtered"),
        victims.alias("with_victims"),
        (n - victims).alias("without_victims"),
        *[F.coalesce(F.sum(v), F.lit(0)).alias(f"total_{v}") for v in VICTIMS],
        F.round(F.avg("relevance_score"), 2).alias("mean_relevance"),
        pct(n, loaded).alias("filter_rate"),
        pct(victims, n).alias("victim_rate"),
    )


def batch_statistics(runs: DataFrame) -> DataFrame:
    """Items, mean per combination and combinations per second of a run log.

    ``runs``: items, duration_s; one row per keyword-place combination.
    """
    n = F.count(F.lit(1))
    return runs.agg(
        n.alias("combinations"),
        F.sum("items").alias("items"),
        F.round(F.avg("items"), 4).alias("items_per_combination"),
        F.round(F.try_divide(n.cast("double"), F.sum("duration_s")), 4).alias("combinations_per_s"),
    )


def coordinate_profile(df: DataFrame) -> DataFrame:
    """Row count, missing coordinates and their range in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("latitude").isNull()).alias("null_lat"),
        F.count_if(F.col("longitude").isNull()).alias("null_lon"),
        F.min("latitude").alias("min_lat"), F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"), F.max("longitude").alias("max_lon"),
    )


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).dropna().distinct()


def top_values(df: DataFrame, col: str, k: int = 3) -> DataFrame:
    """The k most frequent values; ties by name. Top-k never sorts the table."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col).limit(k)


def newest(df: DataFrame, cols: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of an ordering, with the chosen columns."""
    return df.select(*cols).orderBy(*order).limit(n)


def search_plan(
    keywords: list[str], localities: DataFrame, days: int, seed: str = "",
    priority: list[str] | None = None,
) -> DataFrame:
    """Keyword-locality pairs ordered for searching.

    Priority keywords share the front in proportion min(10, days) / 10, the
    rest of them go last. The order within a class is a seeded hash, so a plan
    repeats. Adds ``block`` (0 front, 1 normal, 2 back). Which priority pairs
    come first is decided by a hash threshold counted over the data, exact to
    the row.
    """
    from hazardspark.functions.text import contains_any

    words = vocab.PRIORITY_TERMS if priority is None else priority
    pairs = localities.withColumn("keyword", F.explode(F.array(*[F.lit(k) for k in keywords])))
    key = F.md5(F.concat_ws("|", F.lit(seed), "keyword", *localities.columns).cast("binary"))
    pairs = pairs.withColumns({"_prio": contains_any(F.lower("keyword"), words), "_hash": key})
    return _front_share(pairs, min(10, days) / 10)


def _front_share(pairs: DataFrame, factor: float) -> DataFrame:
    """Mark the int(n * factor) smallest hashes among the priority pairs.

    Hash prefixes are counted first; only the one prefix that straddles the
    cut is ranked row by row.
    """
    from pyspark.sql import Window as W

    prio = pairs.where("_prio")
    prefix = F.substring("_hash", 1, 3)  # at most 4096 groups
    by_prefix = prio.groupBy(prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    running = F.sum("_n").over(W.orderBy("_prefix").rowsBetween(W.unboundedPreceding, 0))
    total = F.sum("_n").over(W.partitionBy())
    cuts = by_prefix.select(
        "_prefix", (running - F.col("_n")).alias("_before"), running.alias("_upto"),
        F.floor(total * F.lit(factor)).alias("_quota"),
    )
    marked = pairs.withColumn("_prefix", prefix).join(F.broadcast(cuts), "_prefix", "left")
    split = marked.where(
        F.col("_prio") & (F.col("_before") < F.col("_quota")) & (F.col("_upto") > F.col("_quota"))
    )
    in_split = F.row_number().over(W.partitionBy("_prefix").orderBy("_hash"))
    whole = marked.where(
        ~(F.col("_prio") & (F.col("_before") < F.col("_quota")) & (F.col("_upto") > F.col("_quota")))
    ).withColumn("_front", F.col("_upto") <= F.col("_quota"))
    ranked = split.withColumn("_front", F.col("_before") + in_split <= F.col("_quota"))
    block = F.when(~F.col("_prio"), 1).when(F.col("_front"), 0).otherwise(2)
    return (
        whole.unionByName(ranked)
        .withColumn("block", block)
        .withColumnRenamed("_hash", "position_key")
        .drop("_prio", "_prefix", "_before", "_upto", "_quota", "_front")
    )


def confirmed_share(
    reports: DataFrame, news: DataFrame, district: str = "district", date: str = "date",
    victims: str = "victims", days: int = 2,
) -> DataFrame:
    """Per report row whether news of the same district and victim count lies within +-days.

    News is reduced to distinct (district, day, victims) and each day is copied
    to the days it confirms, which turns the range condition into an equi join
    against unique keys; no pairs are produced.
    """
    spread = F.explode(F.sequence(F.date_sub(date, days), F.date_add(date, days)))
    confirming = (
        news.select(district, date, victims).distinct()
        .select(district, spread.alias(date), victims).distinct()
        .withColumn("confirmed", F.lit(True))
    )
    return reports.join(confirming, [district, date, victims], "left").withColumn(
        "confirmed", F.coalesce("confirmed", F.lit(False))
    )


def span_quality(spans: DataFrame) -> DataFrame:
    """Precision and recall per label of the title extractor over labelled spans, spelled-out numbers included."""
    words = F.create_map(*[F.lit(x) for pair in (vocab.NUMBER_WORDS | vocab.TITLE_NUMBER_WORDS).items() for x in pair])
    rows = spans.select(
        F.col("label").alias("true_label"), F.coalesce(F.col("span").try_cast("int"), F.try_element_at(words, F.lower("span"))).alias("value"),
        X.title_victims(F.col("text")).alias("v"),
    )
    stacked = rows.select(
        "true_label", "value",
        F.explode(F.array(*[F.struct(F.lit(v.upper()).alias("label"), F.col(f"v.{v}").alias("guess")) for v in VICTIMS])).alias("g"),
    ).select("g.*", F.when(F.col("true_label") == F.col("g.label"), F.col("value")).otherwise(0).alias("truth"))
    right = F.count_if((F.col("guess") > 0) & (F.col("guess") == F.col("truth")))
    n_true, n_found = F.count_if(F.col("truth") > 0), F.count_if(F.col("guess") > 0)
    return stacked.groupBy("label").agg(
        n_true.alias("n_true"), n_found.alias("n_found"), right.alias("n_right"),
        F.round(F.try_divide(right, n_found), 4).alias("precision"), F.round(F.try_divide(right, n_true), 4).alias("recall"),
    )
