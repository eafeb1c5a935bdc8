"""Insert-or-update on a key, as a pure function of two frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hazardspark.operators.dedupe import grouped_as_they_are, keep_last


def greatest(df: DataFrame, key: str) -> DataFrame:
    """The greatest row per key, by its other columns in turn; nulls are below everything.

    As ``keep_last`` in the order of all other columns, but a row travels once and not beside its rank.
    """
    others = [c for c in df.columns if c != key]
    if not others or key not in grouped_as_they_are(df, [key]):
        return keep_last(df, [key], others)
    # A struct's nulls sort first, which is where they belong.
    row = F.max(F.struct(*[F.col(f"`{c}`") for c in others])).alias("_row")
    return df.groupBy(key).agg(row).select(*[F.col(f"`{c}`") if c == key else F.col(f"_row.`{c}`") for c in df.columns])


def _dealt(target: DataFrame, source: DataFrame, key: str, update: set[str], updated_at: Column | None) -> DataFrame:
    """The rows of the full join (``source`` is unique, without null keys), dealt by the key.

    A full join's key comes from either side, so Spark no longer knows where a key is and shuffles whole rows for the
    next step that needs it; the two sides one below the other stay where they are, a key's source row after the others.
    """
    columns = target.columns
    given = [F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in columns]
    kinds = {f.name: f.dataType for f in target.schema.fields}

    def side(df: DataFrame, new: bool) -> DataFrame:
        # A second column that is the key's (a page that is the id too) would name two places for the rows, and Spark no
        # longer sees that both sides lie alike; as a text of its own it does not.
        own = lambda c: F.concat(c, F.lit("")).alias(c) if c != key and kinds[c] == kinds[key] == StringType() else F.col(c)
        return df.select(*[own(c) for c in columns], F.lit(new).alias("_new"))

    both = side(target.repartition(key), False).unionByName(side(source.select(*given), True))
    each = Window.partitionBy(key).orderBy("_new").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    changing = [c for c in columns if c in update and c != key]
    seen = both.withColumns(
        {"_unknown": F.first("_new").over(each), "_changed": F.last("_new").over(each), **{f"_to_{c}": F.last(c).over(each) for c in changing}}
    )

    def merged(c: str) -> Column:
        if c == "updated_at" and updated_at is not None:
            return F.when(F.col("_changed") & ~F.col("_new"), updated_at).otherwise(F.col(c))
        return F.when(F.col("_changed"), F.col(f"_to_{c}")).otherwise(F.col(c)) if c in changing else F.col(c)

    return seen.where(~F.col("_new") | F.col("_unknown")).select(*[merged(c).alias(c) for c in columns])


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update_cols: list[str] | None = None,
    order: list[str] | None = None,
    updated_at: Column | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Target after the source rows are merged in.

    New keys insert the whole source row; known keys take only
    ``update_cols`` (default: all columns but the key). ``order`` ranks source
    rows of one key, the last wins; without it the greatest row does, so a key
    is inserted once either way. A source row without a key is left out.
    ``updated_at`` is stamped on changed rows. Both sides are unique on the
    key, so the full join cannot skew. ``dealt`` gives the same rows dealt by
    the key, for steps that need them so next.
    """
    columns = target.columns
    update = set(update_cols if update_cols is not None else [c for c in columns if c != key])
    source = source.where(F.col(key).isNotNull())
    source = keep_last(source, [key], order) if order else greatest(source, key)
    if dealt:
        return _dealt(target, source, key, update, updated_at)
    s = source.select(
        F.struct(*[F.col(c) if c in source.columns else F.lit(None).alias(c)
                   for c in columns]).alias("_s"),
        F.col(key),
    )
    t = target.select(F.struct(*columns).alias("_t"), F.col(key))
    joined = t.join(s, key, "full_outer")
    in_source, in_target = F.col("_s").isNotNull(), F.col("_t").isNotNull()

    def merged(c: str) -> Column:
        if c == key:
            return F.col(key)
        if c == "updated_at" and updated_at is not None:
            return F.when(in_source & in_target, updated_at).otherwise(
                F.coalesce(F.col("_t.updated_at"), F.col("_s.updated_at"))
            )
        if c in update:
            return F.when(in_source, F.col(f"_s.{c}")).otherwise(F.col(f"_t.{c}"))
        return F.when(in_target, F.col(f"_t.{c}")).otherwise(F.col(f"_s.{c}"))

    return joined.select(*[merged(c).alias(c) for c in columns])
