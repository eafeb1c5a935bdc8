"""Row predicates and the filter cascade.

Predicates are Columns that never read null: a missing value counts as false
unless the operator says otherwise.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hazardspark import vocab
from hazardspark.functions import dates as D
from hazardspark.functions import extract as X
from hazardspark.functions import text as T
from hazardspark.operators import dedupe
from hazardspark.schemas import VICTIMS


def column_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column, or a typed null when the frame lacks it."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(dtype)


def with_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """Named columns as integer counts; absent ones become 0. Integers are not parsed again."""
    types = dict(df.dtypes)

    def count(n: str) -> Column:
        if n not in types:
            return F.lit(0)
        return F.coalesce(F.col(n), F.lit(0)) if types[n] == "int" else T.to_count(F.col(n))

    return df.withColumns({n: count(n) for n in names})


def _low(col: Column, lowered: bool = False) -> Column:
    return col if lowered else F.lower(F.coalesce(col, F.lit("")))


def with_lowered(df: DataFrame) -> DataFrame:
    """``_url`` and ``_title``: page and title in lower case, computed once."""
    return T.computed_once(df, _url=_low(F.col("page")), _title=_low(F.col("title")))


def has_required(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Rows whose required fields are all non-blank."""
    names = names or ["ID", "link", "title"]
    filled = [F.coalesce(F.length(F.trim(F.col(n))) > 0, F.lit(False)) for n in names]
    return df.where(reduce(Column.__and__, filled))


def is_off_topic(title: Column, lowered: bool = False) -> Column:
    """An off-topic word and no hazard word in the title."""
    text = _low(title, lowered)
    return T.contains_any(text, vocab.OFF_TOPIC) & ~T.contains_any(text, vocab.ON_TOPIC)


def is_foreign_news(title: Column, url: Column, lowered: bool = False) -> Column:
    """A foreign country in title or url, or an international section in the url."""
    where = _low(url, lowered)
    return (
        T.contains_any(_low(title, lowered), vocab.FOREIGN_COUNTRIES)
        | T.contains_any(where, vocab.FOREIGN_COUNTRIES)
        | T.contains_any(where, vocab.FOREIGN_URL_HINTS)
    )


def _title_name(col: Column) -> Column:
    return T.title_case(T.strip(F.coalesce(col, F.lit(""))))


def _flag_known(df: DataFrame, col: str, known: DataFrame, flag: str) -> DataFrame:
    """Boolean column: the value is in the one-column list ``known``."""
    names = known.select(F.col(known.columns[0]).alias(col)).distinct().withColumn(flag, F.lit(True))
    return df.join(names, col, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def with_place_flags(
    df: DataFrame, districts: DataFrame, parishes: DataFrame, variants: bool
) -> DataFrame:
    """``_district_ok`` and ``_parish_ok``; lists join on the title-cased name."""
    raw = F.coalesce(F.col("district"), F.lit(""))
    spelled = _title_name(F.col("district"))
    if variants:
        lowered = F.lower(T.strip(raw))
        spelled = F.when(lowered.isin(vocab.DISTRICT_VARIANTS), F.initcap(lowered)).otherwise(spelled)
    out = df.withColumns({"_district": spelled, "_parish": _title_name(F.col("parish"))})
    out = _flag_known(out, "_district", districts, "_district_ok")
    out = _flag_known(out, "_parish", parishes, "_parish_ok")
    return out.withColumn("_parish_ok", F.col("_parish_ok") | (F.col("_parish") == "")).drop(
        "_district", "_parish"
    )


def national_articles(df: DataFrame, districts: DataFrame, parishes: DataFrame) -> DataFrame:
    """Known district, known or empty parish, no excluded word in the url."""
    rows = T.computed_once(df, _url=_low(F.col("page")))
    rows = rows.where(~T.contains_any(F.col("_url"), vocab.NATIONAL_EXCLUDED)).drop("_url")
    return (
        with_place_flags(rows, districts, parishes, variants=False)
        .where(F.col("_district_ok") & F.col("_parish_ok"))
        .drop("_district_ok", "_parish_ok")
    )


def url_is_home_or_neutral(page: Column, lowered: bool = False) -> Column:
    url = _low(page, lowered)
    return T.contains_any(url, vocab.HOME_URL_HINTS) | ~T.contains_any(url, vocab.FOREIGN_URL_WORDS)


def geographic(df: DataFrame, districts: DataFrame, parishes: DataFrame) -> DataFrame:
    """Known district (or variant), known or empty parish, home or neutral url."""
    # The url test needs no join, so it runs before the list lookups.
    rows = df if "_url" in df.columns else T.computed_once(df, _url=_low(F.col("page")))
    rows = rows.where(url_is_home_or_neutral(F.col("_url"), True)).drop("_url")
    return (
        with_place_flags(rows, districts, parishes, True)
        .where(F.col("_district_ok") & F.col("_parish_ok"))
        .drop("_district_ok", "_parish_ok")
    )


def quality_points(page: Column, title: Column, lowered: bool = False) -> Column:
    url = _low(page, lowered)
    checks = [
        (F.length(url) > 20) & ~F.endswith(url, F.lit("/")),
        F.length(F.coalesce(title, F.lit(""))) > 10,
        ~T.contains_any(url, vocab.SOCIAL_MEDIA),
        ~T.contains_any(url, vocab.FORUM_WORDS),
        T.contains_any(url, vocab.KNOWN_OUTLETS),
    ]
    return reduce(Column.__add__, [c.cast("int") for c in checks])


def is_quality(page: Column, title: Column, lowered: bool = False) -> Column:
    """At least three of five quality checks hold."""
    return quality_points(page, title, lowered) >= 3


def is_recent(date: Column, as_of: str | dt.date, max_age_days: int = 365) -> Column:
    """0 <= age in whole days <= limit; unparseable and missing dates are kept.

    ``date`` is text in Y-m-d, d/m/Y or Y-m-d H:M:S.
    """
    s = date
    day = F.coalesce(
        F.when(F.rlike(s, F.lit(r"^\d{4}-\d{1,2}-\d{1,2}$")), F.try_to_date(s, "yyyy-M-d")),
        F.when(F.rlike(s, F.lit(r"^\d{1,2}/\d{1,2}/\d{4}$")), F.try_to_date(s, "d/M/yyyy")),
    )
    stamp = F.when(
        F.rlike(s, F.lit(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$")),
        F.try_to_timestamp(s, F.lit("yyyy-M-d H:m:s")),
    )
    target = F.to_date(F.lit(str(as_of)))
    # A time of day after midnight takes one more day off the age (floor).
    late = (stamp > stamp.cast("date").cast("timestamp")).cast("int")
    age = F.coalesce(F.datediff(target, day), F.datediff(target, stamp.cast("date")) - late)
    return F.coalesce(age.between(0, max_age_days), F.lit(True))


def _counts() -> Column:
    return F.array(*[F.coalesce(F.col(v), F.lit(0)).cast("bigint") for v in VICTIMS])


def victims_plausible(limit: int = 10000) -> Column:
    """Each count and their sum within the limit, sum above 0; negatives do not count."""
    zero = F.lit(0).cast("bigint")
    total = lambda counts: F.aggregate(counts, zero, lambda acc, n: acc + F.greatest(n, zero))
    return F.exists(
        F.array(_counts()),
        lambda counts: F.exists(
            F.array(total(counts)),
            lambda sum_: (sum_ > 0) & (sum_ <= limit) & (F.array_max(counts) <= limit),
        ),
    )


def any_victims() -> Column:
    """Any count above 0."""
    return F.greatest(*[F.coalesce(F.col(v), F.lit(0)) for v in VICTIMS]) > 0


def victim_total() -> Column:
    return reduce(Column.__add__, [F.coalesce(F.col(v), F.lit(0)).cast("bigint") for v in VICTIMS])


def with_victims(df: DataFrame) -> DataFrame:
    """Rows whose counts sum above 0 after coercion."""
    return with_counts(df, VICTIMS).where(victim_total() > 0)


def long_enough_title(title: Column) -> Column:
    return F.coalesce(F.length(title) >= 10, F.lit(False))


def in_publication_window(published: Column, as_of: str | dt.date, days: int) -> Column:
    """as_of - days <= publication date <= as_of; undated rows are out."""
    day = D.parse_rss(published).cast("date")
    end = F.to_date(F.lit(str(as_of)))
    return F.coalesce(day.between(F.date_sub(end, days), end), F.lit(False))


def catalogue_rows(country: Column, kind: Column, want=("portugal", "flood")) -> Column:
    return F.coalesce((F.lower(country) == want[0]) & (F.lower(kind) == want[1]), F.lit(False))


def valid_coordinates(lat: Column, lon: Column, sentinel: float = -999.0) -> Column:
    return lat.isNotNull() & lon.isNotNull() & (lat != sentinel) & (lon != sentinel)


def known_hazard(kind: Column, kinds=("Flood", "Landslide")) -> Column:
    return F.coalesce(T.capitalize(kind).isin(*kinds), F.lit(False))


def publishable() -> Column:
    """Events with coordinates and date whose type is not ``other``."""
    return (
        F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
        & F.col("date").isNotNull()
        & (F.lower("type") != "other")
    )


def named_district(col: Column) -> Column:
    return col.isNotNull() & ~col.isin("", "Nan", "None", "nan")


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def drop_invalid_dates(df: DataFrame, col: str = "date") -> DataFrame:
    """Date text to DD/MM/YYYY; rows without a valid date go."""
    return df.withColumn(col, D.to_dmy_text(F.col(col))).where(F.col(col).isNotNull())


def route(kind: Column, sentinel: str = "Other") -> Column:
    """``relevant`` when typed or with victims, else ``irrelevant``; null type is ``error``."""
    return (
        F.when(kind.isNull(), "error")
        .when((kind != sentinel) | any_victims(), "relevant")
        .otherwise("irrelevant")
    )


# --- cascade ---------------------------------------------------------------------------------


def _row_stages(as_of: str | dt.date, max_age_days: int) -> list[tuple[str, Column]]:
    """Row-level stages after the place lookup, in the reported order."""
    url, title = F.col("_url"), F.col("_title")
    return [
        ("quality", is_quality(url, title, lowered=True)),
        ("keyword", X.keyword_gate_passes(url, lowered=True)),
        ("temporal", is_recent(F.col("date"), as_of, max_age_days)),
        ("victims", victims_plausible()),
        ("relevance", F.col("_score") >= vocab.MIN_RELEVANCE),
    ]


def _prepared(df: DataFrame) -> DataFrame:
    out = with_lowered(with_counts(df, [*VICTIMS, "year"]))
    return out if "ml_relevance_score" in out.columns else out.withColumn("ml_relevance_score", F.lit(1.0))


def _scored(df: DataFrame) -> DataFrame:
    """``_text`` and its ``_score``, each computed once."""
    out = T.computed_once(df, _text=F.concat("_url", F.lit(" "), "_title"))
    return T.computed_once(out, _score=X.relevance_score(F.col("_text")))


def cascade(
    df: DataFrame,
    districts: DataFrame,
    parishes: DataFrame,
    as_of: str | dt.date,
    order: list[str],
    max_age_days: int = 365,
    keep: Column | None = None,
) -> DataFrame:
    """Articles to filtered articles.

    Row predicates run first and in one pass, the two keep-first steps last,
    the storm name on the survivors. ``keep`` is an optional relevance-model
    mask (see :mod:`hazardspark.operators.relevance`).
    """
    out = _prepared(df if keep is None else df.where(keep))
    *cheap, (_, relevant) = _row_stages(as_of, max_age_days)
    for _, test in sorted(cheap, key=lambda stage: stage[0] in ("quality", "keyword")):
        out = out.where(test)
    out = geographic(_scored(out).where(relevant), districts, parishes)
    out = dedupe.dedupe_articles(out, order).withColumns(
        {
            "relevance_score": F.col("_score"),
            "matched_categories": X.relevance_categories(F.col("_text")),
            "evento_nome": X.storm_name(F.col("page")),
        }
    )
    return drop_empty_rows(out.drop("_title", "_text", "_score"))


def _tested(df: DataFrame, as_of: str | dt.date, max_age_days: int) -> DataFrame:
    """``_passed``: how many leading row stages a row passes; ``_text`` and its ``_score`` where it passes all but the last."""
    # Only rows that pass all other stages are scored.
    *early, (_, relevant) = _row_stages(as_of, max_age_days)
    reached = F.lit(len(early))
    for i, (_, test) in reversed(list(enumerate(early))):
        reached = F.when(F.coalesce(test, F.lit(False)), reached).otherwise(i)
    text = F.concat("_url", F.lit(" "), "_title")
    out = T.computed_once(_prepared(df), _reached=reached)
    out = T.computed_once(out, _text=F.when(F.col("_reached") == len(early), text))
    out = T.computed_once(out, _score=F.when(F.col("_text").isNotNull(), X.relevance_score(F.col("_text"))))
    passed = F.col("_reached") + F.coalesce(relevant, F.lit(False)).cast("int")
    return T.computed_once(out, _passed=passed).drop("_reached")


def _staged(
    df: DataFrame, districts: DataFrame, parishes: DataFrame, as_of: str | dt.date, max_age_days: int, carried: list[str]
) -> tuple[DataFrame, list[str]]:
    """Every row as ``_stages``, how many leading stages of the cascade it passes, and the stages' names.

    The row stages are tested before the place lookup, so that only rows which pass them all bring their columns
    ``carried`` to it (``_row``); of the others the place and the number of stages are all that is counted.
    """
    names = ["geographic", *[name for name, _ in _row_stages(as_of, max_age_days)]]
    tested = T.computed_once(_tested(df, as_of, max_age_days), _home=url_is_home_or_neutral(F.col("_url"), True))
    whole = F.col("_home") & (F.col("_passed") == len(names) - 1)
    narrow = T.computed_once(tested, _row=F.when(whole, F.struct(*[F.col(f"`{c}`") for c in carried])))
    placed = with_place_flags(narrow.select("district", "parish", "_home", "_passed", "_row"), districts, parishes, True)
    geo = F.col("_home") & F.col("_district_ok") & F.col("_parish_ok")
    stages = F.when(geo, F.col("_passed") + 1).otherwise(0)
    return T.computed_once(placed, _stages=stages).select("_stages", "_row"), names


def _observed(rows: DataFrame, names: list[str]) -> tuple[DataFrame, Observation]:
    """The rows of ``_staged`` that pass all stages, and how many rows each stage leaves."""
    counts = Observation()
    at_least = [F.count_if(F.col("_stages") >= i).alias(n) for i, n in enumerate(["loaded", *names])]
    return rows.observe(counts, *at_least).where(F.col("_stages") == len(names)).select("_row.*"), counts


def _table_of_counts(spark: SparkSession, names: list[str], *observed: Observation) -> DataFrame:
    got = {name: n for o in observed for name, n in o.get.items()}
    found = [(i, n, got[n]) for i, n in enumerate(["loaded", *names, "page_dedupe", "content_dedupe"])]
    return spark.createDataFrame(found, "stage_no int, stage string, n_rows long")


def observed_cascade(
    df: DataFrame,
    districts: DataFrame,
    parishes: DataFrame,
    as_of: str | dt.date,
    order: list[str],
    max_age_days: int = 365,
) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The rows of ``cascade``, and a function that gives the rows left after every stage as (stage_no, stage, n_rows).

    The counts are metrics of the one pass that computes the rows: call the function after an action on them (it waits
    for one). The stages are counted in the reported order; the rows are the same in any order of the tests.
    """
    staged, names = _staged(df, districts, parishes, as_of, max_age_days, [*df.columns, "_text", "_score"])
    rows, row_level = _observed(staged, names)
    by_page, by_content = Observation(), Observation()
    rows = dedupe.keep_first(rows, ["page"], order).observe(by_page, F.count(F.lit(1)).alias("page_dedupe"))
    content = dedupe.content_keys(rows)
    rows = dedupe.keep_first(rows, content, order) if content else rows
    rows = rows.observe(by_content, F.count(F.lit(1)).alias("content_dedupe"))
    rows = rows.withColumns(
        {
            "relevance_score": F.col("_score"),
            "matched_categories": X.relevance_categories(F.col("_text")),
            "evento_nome": X.storm_name(F.col("page")),
        }
    )
    counts = lambda: _table_of_counts(df.sparkSession, names, row_level, by_page, by_content)
    return drop_empty_rows(rows.drop("_text", "_score")), counts


def cascade_counts(
    df: DataFrame,
    districts: DataFrame,
    parishes: DataFrame,
    as_of: str | dt.date,
    order: list[str],
    max_age_days: int = 365,
) -> DataFrame:
    """Rows left after every stage, in the reported order, as (stage_no, stage, n_rows); the rows go nowhere.

    Only the columns that tell rows apart or order them are moved. Which row of a content is first changes no count.
    """
    content = dedupe.content_keys(df)
    carried = list(dict.fromkeys(["page", *order, *content]))
    staged, names = _staged(df, districts, parishes, as_of, max_age_days, carried)
    rows, row_level = _observed(staged, names)
    by_page, by_content = Observation(), Observation()
    rows = dedupe.keep_first(rows, ["page"], order).observe(by_page, F.count(F.lit(1)).alias("page_dedupe"))
    rows = rows.select(*content).distinct() if content else rows
    rows = rows.observe(by_content, F.count(F.lit(1)).alias("content_dedupe"))
    rows.write.format("noop").mode("overwrite").save()
    return _table_of_counts(df.sparkSession, names, row_level, by_page, by_content)
