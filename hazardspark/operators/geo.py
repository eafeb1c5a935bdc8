"""Georeferencing: gazetteer lookups, centroid hierarchy, places named in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardspark import vocab
from hazardspark.functions import text as T
from hazardspark.session import rewritten
from hazardspark.sources.tables import estimated_bytes


def _key(col: Column) -> Column:
    return F.lower(F.trim(col))


def _level(centroids: DataFrame, column: str, tag: str) -> DataFrame:
    """One point per name: the lowest code wins, so reruns agree."""
    return (
        centroids.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .groupBy(_key(F.col(column)).alias(f"_k_{tag}"))
        .agg(
            F.min_by(
                F.struct("latitude", "longitude"),
                F.struct(F.coalesce("dicofre", F.lit("")), "latitude", "longitude"),
            ).alias(f"_p_{tag}")
        )
        .where(F.col(f"_k_{tag}").isNotNull())
    )


# Centroid column, event column and class label per level, most precise first.
LEVELS = [
    ("freguesia", "parish", "freguesia"),
    ("concelho", "municipality", "concelho"),
    ("distrito", "district", "distrito"),
]


#: Keys of their own that rows without a usable name are dealt over.
_APART = 4096


def _apart(events: DataFrame, tag: str) -> Column:
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in events.columns]), F.lit(_APART))
    return F.concat(F.lit(tag), salt.cast("string"))


def written_levels(centroids: DataFrame) -> list[DataFrame]:
    """``LEVELS`` of the centroids, one row per name (``_name_*``, ``_p_*``) and written, so that Spark knows their true size."""
    levels = []
    for column, event_col, _ in LEVELS:
        level = rewritten(_level(centroids, column, event_col), f"level-{event_col}")
        levels.append(level.withColumnRenamed(f"_k_{event_col}", f"_name_{event_col}"))
    return levels


def _broadcast(level: DataFrame) -> bool:
    """Whether Spark joins the level by broadcast."""
    limit = level.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(level) <= limit


def locate(events: DataFrame, centroids: DataFrame, key: str | None = None) -> DataFrame:
    """Fill missing coordinates from parish, else municipality, else district.

    Latitude and longitude always come from one centroid; ``georef_class``
    names the level that supplied them. Rows with coordinates and rows no level
    resolves stay untouched. Each level is one row per name and joins once. The
    levels are written first: Spark then knows their true size and broadcasts
    the small ones instead of shuffling all events to a few names.

    With ``key``, a column without nulls, events dealt by it stay where they
    are: only the keys and names of events that need a point travel to a level
    too large to broadcast, and its points back. Repeated keys each get the
    point of their own name.
    """
    return locate_by(events, written_levels(centroids), key)


def locate_by(events: DataFrame, levels: list[DataFrame], key: str | None = None) -> DataFrame:
    """``locate`` with the levels of ``written_levels``."""
    out = events
    needs = F.col("latitude").isNull() | F.col("longitude").isNull()
    for (_, event_col, _), level in zip(LEVELS, levels):
        k, given, name = f"_k_{event_col}", f"_name_{event_col}", _key(F.col(event_col))
        all_empty = F.transform(F.sequence(F.lit(0), F.lit(_APART - 1)), lambda i: F.concat(F.lit("empty:"), i.cast("string")))
        level = level.withColumn(k, F.explode(F.when(F.col(given) == "", all_empty).otherwise(F.array(F.concat(F.lit("name:"), F.col(given))))))
        if key is not None and not _broadcast(level):
            asked = events.where(needs & name.isNotNull()).select(F.col(key).alias("_id"), name.alias("_asked")).distinct()
            asked = asked.select(
                "_id", F.when(F.col("_asked") == "", _apart(asked, "empty:")).otherwise(F.concat(F.lit("name:"), F.col("_asked"))).alias(k)
            )
            found = asked.join(level, k).drop(k)
            # The names are compared, not joined on: the key alone says where events are.
            own = F.coalesce(name == F.col(given), F.lit(False)) & needs
            out = out.join(found, (F.col(key) == F.col("_id")) & own, "left").drop("_id", given)
            continue
        # Rows that need nothing, or have no name, get one of many keys that no name has: they never meet the
        # lookup and do not gather in one task. Those with an empty name are dealt out too, and so is its point.
        apart = (
            F.when(needs & (name == ""), _apart(events, "empty:")).when(needs & name.isNotNull(), F.concat(F.lit("name:"), name))
            .otherwise(_apart(events, "none:"))
        )
        out = out.withColumn(k, apart).join(level.drop(given), k, "left")
    point = F.coalesce(*[F.col(f"_p_{e}") for _, e, _ in LEVELS])
    label = F.coalesce(
        *[F.when(F.col(f"_p_{e}").isNotNull(), F.lit(name)) for _, e, name in LEVELS]
    )
    found = needs & point.isNotNull()
    return out.withColumns(
        {
            "latitude": F.when(found, point["latitude"]).otherwise(F.col("latitude")),
            "longitude": F.when(found, point["longitude"]).otherwise(F.col("longitude")),
            "georef_class": F.when(found, label).otherwise(F.col("georef_class")),
        }
    ).select(*events.columns)


def with_geometry(events: DataFrame) -> DataFrame:
    """WKT point where coordinates exist and no geometry is set."""
    return events.withColumn(
        "location_geom",
        F.coalesce("location_geom", T.wkt_point(F.col("latitude"), F.col("longitude"))),
    )


def municipality_point(
    df: DataFrame, centroids: DataFrame, default: tuple[float, float] = vocab.DEFAULT_POINT
) -> DataFrame:
    """Point of (district, municipality); the default point resets the class to 0."""
    points = (
        centroids.where(F.col("concelho").isNotNull())
        .groupBy(F.lower("distrito").alias("_kd"), F.lower("concelho").alias("_km"))
        .agg(
            F.min_by(
                F.struct("latitude", "longitude"),
                F.struct(F.coalesce("dicofre", F.lit("")), "latitude", "longitude"),
            ).alias("_p")
        )
    )
    out = df.withColumns({"_kd": F.lower("district"), "_km": F.lower("municipality")}).join(
        points, ["_kd", "_km"], "left"
    )
    hit = F.col("_p.latitude").isNotNull() & F.col("_p.longitude").isNotNull()
    return out.withColumns(
        {
            "latitude": F.when(hit, F.col("_p.latitude")).otherwise(F.lit(default[0])),
            "longitude": F.when(hit, F.col("_p.longitude")).otherwise(F.lit(default[1])),
            "georef_class": F.when(hit, F.col("georef_class")).otherwise(0),
        }
    ).drop("_kd", "_km", "_p")


def assign_district(
    df: DataFrame,
    municipalities: DataFrame,
    location: str = "Location",
    aliases: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """district, municipality and class: alias (2), known municipality (3), else unknown (0).

    ``municipalities`` has columns district, municipality.
    """
    aliases = vocab.REGION_ALIASES if aliases is None else aliases
    known = (
        municipalities.groupBy(F.lower("municipality").alias("_k"))
        .agg(F.min(F.struct("district", "municipality")).alias("_m"))
    )
    name = F.col(location)
    out = df.withColumn("_k", F.lower(name)).join(known, "_k", "left")
    if aliases:
        pair = lambda v: F.struct(F.lit(v[0]).alias("district"), F.lit(v[1]).alias("municipality"))
        table = F.create_map(*[x for k, v in aliases.items() for x in (F.lit(k), pair(v))])
        alias = F.element_at(table, name)
    else:
        alias = F.lit(None).cast("struct<district:string,municipality:string>")
    unknown = F.struct(F.lit(vocab.UNKNOWN_DISTRICT).alias("district"), name.alias("municipality"))
    place = F.coalesce(alias, F.col("_m"), unknown)
    return out.withColumns(
        {
            "district": place["district"],
            "municipality": place["municipality"],
            "georef_class": F.when(alias.isNotNull(), 2).when(F.col("_m").isNotNull(), 3).otherwise(0),
        }
    ).drop("_k", "_m")


def enrich_place(df: DataFrame, places: DataFrame, codes: DataFrame, loc: str = "loc") -> DataFrame:
    """district and municipality of a place name and its parish code; unmatched is ''.

    ``places``: place_key, district, municipality; ``codes``: name, code (both unique).
    """
    return (
        df.withColumns({"place_key": F.lower(loc), "name": T.normalize(F.lower(loc))})
        .join(places.select("place_key", "district", "municipality"), "place_key", "left")
        .join(codes.select("name", "code"), "name", "left")
        .withColumns(
            {
                "district": F.coalesce("district", F.lit("")),
                "municipality": F.coalesce("municipality", F.lit("")),
                "DICOFREG": F.coalesce("code", F.lit("")),
            }
        )
        .drop("place_key", "name", "code")
    )


# --- places named in text --------------------------------------------------------------------

# Names are anchored by a gram of the largest size that fits them.
GRAM_SIZES = (4, 2, 1)
SMALL_GAZETTEER_BYTES = 8 * 1024 * 1024
# Up to so many names are looked for one by one in the row itself, which is cheaper than the grams of a text.
FEW_NAMES = 128


def _grams(col: Column, size: int) -> Column:
    """Distinct overlapping substrings of one size."""
    return F.array_distinct(F.regexp_extract_all(col, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def _anchors(names: DataFrame) -> DataFrame:
    """Each name with the gram fewest other names share."""
    pick = F.when(F.length("_name") >= GRAM_SIZES[0], _grams(F.col("_name"), GRAM_SIZES[0]))
    for size in GRAM_SIZES[1:]:
        pick = pick.when(F.length("_name") >= size, _grams(F.col("_name"), size))
    grams = names.select("_name", F.explode(pick).alias("_gram"))
    shared = grams.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    return (
        grams.join(shared, "_gram")
        .groupBy("_name")
        .agg(F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram"))
    )


def places_in_text(
    docs: DataFrame, doc_id: str, text: str, places: DataFrame, name: str, rank: str
) -> DataFrame:
    """(doc_id, rank, place) for every gazetteer name that is a substring of the text.

    Both sides are normalised; names that normalise to nothing are skipped.
    The distinct grams of a text meet the names' rarest grams in an equi join
    and survivors are verified against the whole text, so no text is compared
    with every name. A gazetteer below the size bound is broadcast and the
    verification happens in the same pass; a larger one joins grams without
    the text and fetches the texts of the candidates by id and text hash. A
    few names are looked for without grams. The rows are the same either way:
    one per id, text and place, null ids and repeated rows included. The
    gazetteer is written first, so that its true size decides: an estimate of
    its plan grows with the tables it is drawn from.
    """
    return _places_by_text(docs, doc_id, text, _named(places, name, rank), rank).select(doc_id, rank, "place")


def _named(places: DataFrame, name: str, rank: str) -> DataFrame:
    """Written names with their normalised form; names that normalise to nothing are left out."""
    named = places.select(T.normalize(F.col(name)).alias("_name"), F.col(rank), F.col(name).alias("place"))
    return rewritten(named.where(F.length("_name") > 0), "names")


def _few(names: DataFrame) -> bool:
    return len(names.take(FEW_NAMES + 1)) <= FEW_NAMES


def _text_key(text: str) -> Column:
    return F.xxhash64(T.normalize(F.col(text)))


def _places_by_text(docs: DataFrame, doc_id: str, text: str, named: DataFrame, rank: str) -> DataFrame:
    names = named.select("_name").distinct()
    texts = docs.select(F.col(doc_id), T.normalize(F.col(text)).alias("_text")).withColumn("_key", F.xxhash64("_text"))
    if _few(names):
        found = F.filter("_names", lambda n: F.contains("_text", n))
        hits = texts.crossJoin(F.broadcast(names.agg(F.collect_list("_name").alias("_names"))))
        hits = hits.select(doc_id, "_key", F.explode(found).alias("_name")).distinct()
        return hits.join(named, "_name").select(doc_id, "_key", rank, "place")
    anchors = _anchors(names)
    # Texts yield grams only of the sizes that anchor some name.
    all_grams = F.concat(
        *[
            F.when(anchors.agg(F.bool_or(F.length("_gram") == n)).scalar(), _grams(F.col("_text"), n))
            .otherwise(F.array().cast("array<string>"))
            for n in GRAM_SIZES
        ]
    )
    if estimated_bytes(named) <= SMALL_GAZETTEER_BYTES:
        hits = (
            texts.select(doc_id, "_key", "_text", F.explode(all_grams).alias("_gram"))
            .join(F.broadcast(anchors), "_gram")
            .where(F.contains("_text", F.col("_name")))
            .select(doc_id, "_key", "_name").distinct()
        )
    else:
        candidates = (
            texts.select(F.col(doc_id).alias("_id"), F.col("_key").alias("_of"), F.explode(all_grams).alias("_gram"))
            .join(anchors, "_gram")
            .select("_id", "_of", "_name").distinct()
        )
        unique = texts.dropDuplicates([doc_id, "_key"])
        hits = (
            candidates.join(unique, F.col("_id").eqNullSafe(unique[doc_id]) & (F.col("_of") == unique["_key"]))
            .where(F.contains("_text", F.col("_name")))
            .select(doc_id, "_key", "_name")
        )
    return hits.join(named, "_name").select(doc_id, "_key", rank, "place")


def first_place_in_text(
    docs: DataFrame, doc_id: str, text: str, places: DataFrame, name: str, rank: str
) -> DataFrame:
    """Docs with ``place``: the lowest-ranked gazetteer name contained in the text, else null.

    A few names are tried in the row itself, in their order; no text then travels.
    """
    named = _named(places, name, rank)
    if _few(named):
        entry = F.struct(F.col(rank).alias("rank"), "place", "_name")
        listed = named.where(F.col(rank).isNotNull()).agg(F.sort_array(F.collect_list(entry)).alias("_names"))
        # The normalised text is computed below the join, once per row and not once per name.
        texts = docs.withColumn("_text", T.normalize(F.col(text))).crossJoin(F.broadcast(listed))
        held = F.filter("_names", lambda n: F.contains("_text", n["_name"]))
        return texts.select(*docs.columns, F.get(held, F.lit(0))["place"].alias("place"))
    first = (
        _places_by_text(docs, doc_id, text, named, rank)
        .groupBy(F.col(doc_id).alias("_id"), F.col("_key").alias("_of"))
        .agg(F.min_by("place", rank).alias("place"))
    )
    same = docs[doc_id].eqNullSafe(first["_id"]) & (_text_key(text) == first["_of"])
    return docs.join(first, same, "left").select(*[docs[c] for c in docs.columns], "place")


def verified_location(df: DataFrame, place: Column, district: Column) -> DataFrame:
    """Upper-cased municipality and district with the fixed georeference label."""
    hit = place.isNotNull()
    return df.withColumns(
        {
            "municipali": F.upper(place),
            "district": F.upper(district),
            "georef": F.when(hit, F.lit("location based on text scraping")),
        }
    )
