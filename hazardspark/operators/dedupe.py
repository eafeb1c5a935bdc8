"""De-duplication, anti joins and near-duplicate removal.

Every "keep one row per key" is an aggregate, not a window: map-side combine
reduces a key that holds a third of the table to one row per task before the
shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DataType, DateType, IntegralType, NullType, NumericType, StringType, StructType, TimestampNTZType, TimestampType,
)

from hazardspark.functions import text as T
from hazardspark.session import rewritten


def grouped_as_they_are(df: DataFrame, keys: list[str]) -> set[str]:
    """Keys whose value after grouping is the row's own; Spark makes 0.0 of -0.0, also inside nested values."""
    return {k for k in keys if k in df.columns and isinstance(df.schema[k].dataType, (StringType, IntegralType, DateType, BooleanType))}


_PLAIN = (StringType, BinaryType, BooleanType, NumericType, DateType, TimestampType, TimestampNTZType, NullType)


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind)
    return _orderable(kind.elementType) if isinstance(kind, ArrayType) else isinstance(kind, _PLAIN)


def _pick(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    # Such keys come from the grouping, so that a later join or grouping on them needs no second shuffle of whole rows.
    own = grouped_as_they_are(df, keys)
    rest = [c for c in df.columns if c not in own]
    # A null order value loses; it never makes the rank itself null, which would lose the key.
    unknown = lambda c: F.col(c).isNull() if pick is F.min_by else F.col(c).isNotNull()
    if all(_orderable(df.schema[c].dataType) for c in rest):
        # The order columns lead the row, so that they travel once and not beside it.
        lead = [x for i, c in enumerate(order) for x in (unknown(c).alias(f"_k{i}"), F.col(c).alias(f"_o{i}"))]
        others = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(rest) if c not in order]
        best = (F.min if pick is F.min_by else F.max)(F.struct(*lead, *others)).alias("_row")
        place = {c: f"_o{order.index(c)}" if c in order else f"_c{i}" for i, c in enumerate(rest)}
        return df.groupBy(*keys).agg(best).select(
            *[F.col(f"`{c}`") if c in own else F.col(f"_row.{place[c]}").alias(c) for c in df.columns]
        )
    row = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(0))
    known = [unknown(c).alias(f"_k{i}") for i, c in enumerate(order)]
    rank = F.struct(*[x for k, c in zip(known, order) for x in (k, F.col(c))])
    return df.groupBy(*keys).agg(pick(row, rank).alias("_row")).select(
        *[F.col(f"`{c}`") if c in own else F.col(f"_row.`{c}`") for c in df.columns]
    )


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key by ingest order; null keys are equal to each other, a null order comes last."""
    return _pick(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per key by load order (last write wins); a row with an order beats one without."""
    return _pick(df, keys, order, F.max_by)


def dedupe_articles(df: DataFrame, order: list[str]) -> DataFrame:
    """First per page, then first per (district, parish, date, fatalities, injured)."""
    by_page = keep_first(df, ["page"], order)
    content = content_keys(df)
    return keep_first(by_page, content, order) if content else by_page


def content_keys(df: DataFrame) -> list[str]:
    """The columns that tell articles of one event apart from others."""
    return [c for c in ("district", "parish", "date", "fatalities", "injured") if c in df.columns]


def title_and_url(df: DataFrame, title: str, url: str) -> DataFrame:
    """``_title`` and ``_url``: the keys that rows are told apart by."""
    return df.withColumns(
        {"_title": T.title_hash(F.col(title)), "_url": T.base_url(F.coalesce(F.col(url), F.lit("")))}
    )


def keep_first_title_then_url(df: DataFrame, title: str, url: str, order: str) -> DataFrame:
    """First row per title, then first per base url among those kept (two passes)."""
    out = keep_first(title_and_url(df, title, url), ["_title"], [order])
    return keep_first(out, ["_url"], [order]).drop("_title", "_url")


def keep_first_title_or_url(df: DataFrame, title: str, url: str, order: str) -> DataFrame:
    """Rows whose title and base url are both new when read in ``order``.

    A row rejected for one of them registers neither, so the result depends on
    the sequence. It is computed in rounds: a row that comes first for its
    title *and* its url among the undecided is kept, and rows that share either
    with a kept row are dropped. This equals the sequential reading exactly;
    few rounds suffice unless rejections chain. ``order`` must be unique; rows
    without one are not kept.
    """
    pairs = title_and_url(df, title, url).withColumn("_title", F.unhex("_title"))
    undecided = rewritten(
        pairs.groupBy("_title", "_url").agg(F.min(order).alias("_o")).where(F.col("_o").isNotNull()), "undecided"
    )
    kept = []
    while not undecided.isEmpty():
        # First for its title; then only rows with such a url can be first for it.
        titles = undecided.groupBy("_title").agg(F.min_by("_url", "_o").alias("_url"), F.min("_o").alias("_o"))
        titles = rewritten(titles, "titles")
        rivals = undecided.select("_url", "_o").join(titles.select("_url").distinct(), "_url", "left_semi")
        first = rivals.groupBy("_url").agg(F.min("_o").alias("_first"))
        chosen = rewritten(titles.join(first, "_url").where(F.col("_o") == F.col("_first")).drop("_first"), "chosen")
        kept.append(chosen.select("_o"))
        undecided = rewritten(
            undecided.join(chosen.select("_title"), "_title", "left_anti").join(
                chosen.select("_url"), "_url", "left_anti"
            ),
            "undecided",
        )
    if not kept:
        return df.limit(0)
    keep = reduce(DataFrame.unionByName, kept).withColumnRenamed("_o", order)
    return df.join(keep, order, "left_semi")


def not_yet_seen(df: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None) -> DataFrame:
    """Rows whose key is not among the non-null keys already stored.

    The stored keys are reduced to distinct values first; a hot key on the
    left is split by the adaptive skew join.
    """
    keys = seen.select(F.col(seen_key or key).alias(key)).where(F.col(key).isNotNull()).distinct()
    return df.join(keys, key, "left_anti")


# --- near duplicates -------------------------------------------------------------------------

# Cells are narrower than the tolerance, so two points of one cell are always
# near; points up to two cells apart can be.
_CELL_SHARE = 0.6
_REACH = 2


def _cell(col: Column, tolerance: float) -> Column:
    return F.floor(col / F.lit(tolerance * _CELL_SHARE))


def _spread(df: DataFrame) -> DataFrame:
    """One copy of a row per neighbouring cell."""
    steps = F.array(*[F.lit(i) for i in range(-_REACH, _REACH + 1)])
    return (
        df.withColumn("_dx", F.explode(steps))
        .withColumn("_dy", F.explode(steps))
        .withColumns({"_cx": F.col("_cx") + F.col("_dx"), "_cy": F.col("_cy") + F.col("_dy")})
        .drop("_dx", "_dy")
    )


# Blocks of so many cells a side; a cell reaches 2.25 blocks on average.
_BLOCK = 8


def _block(cell: Column) -> Column:
    return F.floor(cell / F.lit(_BLOCK))


def _reached_blocks(df: DataFrame) -> DataFrame:
    """One copy of a row per block that its neighbouring cells lie in."""
    span = lambda c: F.explode(F.sequence(_block(F.col(c) - _REACH), _block(F.col(c) + _REACH)))
    return df.withColumn("_bx", span("_cx")).withColumn("_by", span("_cy")).drop("_cx", "_cy")


def _near(lat: str, lon: str, tolerance: float) -> Column:
    return (F.abs(F.col(lat) - F.col(f"_{lat}")) < tolerance) & (
        F.abs(F.col(lon) - F.col(f"_{lon}")) < tolerance
    )


def _null_keys(keys: list[str]) -> list[Column]:
    # Keys meet by SQL equality: a null key never matches.
    return [F.col(k).isNotNull() for k in keys]


def drop_near_matches(
    df: DataFrame, stored: DataFrame, keys: list[str], lat: str, lon: str, tolerance: float = 1e-5
) -> DataFrame:
    """Rows without a stored row of equal keys within ``tolerance`` on both axes.

    Stored points are reduced to distinct coordinates and copied to the cells
    they can reach; one anti join on keys and cell tests the distance and stops
    at the first match, so no pairs are emitted.
    """
    points = (
        stored.where(reduce(Column.__and__, _null_keys(keys)))
        .select(*keys, F.col(lat).alias(f"_{lat}"), F.col(lon).alias(f"_{lon}"))
        .distinct()
        .withColumns({"_cx": _cell(F.col(f"_{lat}"), tolerance), "_cy": _cell(F.col(f"_{lon}"), tolerance)})
    )
    left = df.withColumns({"_cx": _cell(F.col(lat), tolerance), "_cy": _cell(F.col(lon), tolerance)})
    right = _spread(points)
    on = [left[k] == right[k] for k in [*keys, "_cx", "_cy"]]
    near = (F.abs(left[lat] - right[f"_{lat}"]) < tolerance) & (
        F.abs(left[lon] - right[f"_{lon}"]) < tolerance
    )
    return left.join(right, reduce(Column.__and__, [*on, near]), "left_anti").drop("_cx", "_cy")


def drop_near_repeats(
    df: DataFrame,
    keys: list[str],
    lat: str,
    lon: str,
    order: str,
    tolerance: float = 1e-5,
) -> DataFrame:
    """Read rows in ``order``; drop a row near a row already kept.

    Exact, in rounds. Copies of one coordinate collapse first. Among the
    undecided, only the earliest point of a cell can be kept next, and it is
    unless an earlier undecided point lies near; then everything near a kept
    point is dropped. A cell's candidate goes to the blocks of cells it can
    reach, 2.25 on average, and meets the points at home there, so what a round
    shuffles stays linear even if one place holds a third of all rows; the
    adaptive skew join splits such a place over tasks. ``order`` must be
    unique. Rows with a null key or coordinate are never repeats.
    """
    complete = reduce(
        Column.__and__, [*_null_keys(keys), F.col(lat).isNotNull(), F.col(lon).isNotNull()]
    )
    cells = {"_cx": _cell(F.col(lat), tolerance), "_cy": _cell(F.col(lon), tolerance)}
    undecided = rewritten(
        df.where(complete)
        .groupBy(*keys, lat, lon)
        .agg(F.min(order).alias("_o"))
        .withColumns(cells)
        .withColumns({"_bx": _block(F.col("_cx")), "_by": _block(F.col("_cy"))}),
        "undecided",
    )
    on = [*keys, "_bx", "_by"]
    kept = []
    while not undecided.isEmpty():
        earliest = rewritten(
            undecided.groupBy(*keys, "_cx", "_cy")
            .agg(F.min_by(F.struct(lat, lon), "_o").alias("_p"), F.min("_o").alias("_first"))
            .select(
                *keys, "_cx", "_cy", "_first",
                F.col(f"_p.{lat}").alias(f"_{lat}"), F.col(f"_p.{lon}").alias(f"_{lon}"),
            ),
            "earliest",
        )
        blocked = (
            undecided.join(_reached_blocks(earliest), on)
            .where((F.col("_o") < F.col("_first")) & _near(lat, lon, tolerance))
            .select("_first")
            .distinct()
        )
        chosen = rewritten(earliest.join(blocked, "_first", "left_anti"), "chosen")
        kept.append(chosen.select(F.col("_first").alias(order)))
        near = _reached_blocks(chosen)
        same = reduce(Column.__and__, [undecided[k] == near[k] for k in on])
        undecided = rewritten(undecided.join(near, same & _near(lat, lon, tolerance), "left_anti"), "undecided")
    loose = df.where(~complete)
    if not kept:
        return loose
    keep = reduce(DataFrame.unionByName, kept)
    return df.where(complete).join(keep, order, "left_semi").unionByName(loose)
