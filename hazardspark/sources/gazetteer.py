"""Nested place lists to rows, parish codes, vocabularies, centroid layers, labelled spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardspark import schemas
from hazardspark.functions import text as T
from hazardspark.operators.dedupe import keep_last


def read_nested(spark: SparkSession, path: str, shape) -> DataFrame:
    """A nested JSON file as one map column ``nested``."""
    return spark.read.text(path, wholetext=True).select(F.from_json("value", shape).alias("nested"))


def places_by_province(df: DataFrame, nested: str = "nested") -> DataFrame:
    """(province, district, place): every place, plus each district naming itself."""
    districts = df.select(F.explode(nested).alias("province", "_d")).select(
        "province", F.explode("_d").alias("district", "_places")
    )
    own = F.array("district")
    return districts.select(
        "province", "district",
        F.explode(F.concat(F.coalesce("_places", F.array().cast("array<string>")), own)).alias("place"),
    )


def flat_localities(df: DataFrame, nested: str = "nested") -> DataFrame:
    """The same names as one list, duplicates kept."""
    return places_by_province(df, nested).select(F.col("place").alias("localidade"))


def municipality_lookup(df: DataFrame, nested: str = "nested") -> DataFrame:
    """(place_key, district, municipality) of a district -> [municipality] map.

    One row per lower-cased municipality; the last district in name order wins.
    """
    rows = df.select(F.explode(nested).alias("district", "_m")).select(
        "district", F.explode("_m").alias("municipality")
    )
    return keep_last(
        rows.withColumn("place_key", F.lower("municipality")), ["place_key"], ["district", "municipality"]
    ).select("place_key", "district", "municipality")


def locality_union(*frames: DataFrame) -> DataFrame:
    """Parishes, municipalities and districts as one list, duplicates kept."""
    out = frames[0].toDF("localidade")
    for frame in frames[1:]:
        out = out.unionByName(frame.toDF("localidade"))
    return out


def parish_codes(df: DataFrame, name: str, code: str, order: list[str]) -> DataFrame:
    """(name, code) with normalised names; the last row of a name wins."""
    missing = [c for c in (name, code) if c not in df.columns]
    if missing:
        raise ValueError(f"parish table lacks {', '.join(missing)}")
    ranks = {f"_order_{i}": F.col(c) for i, c in enumerate(order)}
    rows = df.select(
        T.normalize(F.col(name)).alias("name"), F.col(code).alias("code"),
        *[c.alias(n) for n, c in ranks.items()],
    )
    return keep_last(rows, ["name"], list(ranks)).select("name", "code")


def parish_codes_nested(df: DataFrame, nested: str = "nested") -> DataFrame:
    """The same from a district -> municipality -> [{nome, codigo}] map."""
    rows = (
        df.select(F.explode(nested).alias("_district", "_m"))
        .select("_district", F.explode("_m").alias("_municipality", "_p"))
        .select("_district", "_municipality", F.posexplode("_p").alias("_pos", "_f"))
        .select("_district", "_municipality", "_pos", F.col("_f.nome").alias("nome"), F.col("_f.codigo").alias("codigo"))
    )
    return parish_codes(rows, "nome", "codigo", ["_district", "_municipality", "_pos"])


def keywords(spark: SparkSession, path: str, language: str = "portuguese") -> DataFrame:
    """Search terms of one language."""
    raw = spark.read.text(path, wholetext=True)
    nested = F.from_json("value", "struct<weather_terms:map<string,array<string>>>")
    flat = F.from_json("value", "map<string,string>")
    terms = F.coalesce(
        F.element_at(nested["weather_terms"], F.lit(language)),
        F.from_json(F.element_at(flat, F.lit(language)), "array<string>"),
    )
    return raw.select(F.explode(terms).alias("keyword"))


def name_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list of names in file order."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "array<string>").alias("names"))
    return raw.select(F.posexplode("names").alias("position", "name"))


def valid_districts(df: DataFrame, nested: str = "nested") -> DataFrame:
    return df.select(F.explode(F.map_keys(nested)).alias("district")).distinct()


def valid_parishes(df: DataFrame, nested: str = "nested") -> DataFrame:
    return df.select(F.explode(F.flatten(F.map_values(nested))).alias("parish")).distinct()


# Source column -> centroid column, per layer.
CENTROID_LAYERS = {
    "freguesia": {
        "Freguesia": "freguesia", "Concelho": "concelho", "Distrito": "distrito",
        "Dicofre": "dicofre", "AREA_T_Ha": "area_ha",
    },
    "concelho": {"NAME_2": "concelho", "NAME_1": "distrito", "CCA_2": "dicofre"},
}
_CENTROID_COLUMNS = [
    "latitude", "longitude", "name", "region", "distrito", "concelho", "freguesia", "dicofre",
    "area_ha", "centroid_type",
]


def centroid_layer(df: DataFrame, centroid_type: str) -> DataFrame:
    """One layer in the centroid shape; unknown columns go, known ones stay."""
    if not {"latitude", "longitude"} <= set(df.columns):
        raise ValueError("latitude and longitude are required")
    mapping = {k: v for k, v in CENTROID_LAYERS.get(centroid_type, {}).items() if k in df.columns}
    out = df.withColumns({new: F.col(old) for old, new in mapping.items()})
    out = out.withColumn("centroid_type", F.lit(centroid_type))
    named = next((c for c in ("freguesia", "concelho") if c in out.columns), None)
    if named:
        out = out.withColumns({"name": F.col(named), "region": F.col("distrito")})
    else:
        out = out.withColumns(
            {"name": F.lit(f"{centroid_type}_centroid"), "region": F.lit("Portugal")}
        )
    return out.select(*[c for c in _CENTROID_COLUMNS if c in out.columns])


def centroid_table(*layers: DataFrame) -> DataFrame:
    """All layers in the full CENTROID schema."""
    out = layers[0]
    for layer in layers[1:]:
        out = out.unionByName(layer, allowMissingColumns=True)
    for field in schemas.CENTROID.fields:
        value = F.col(field.name) if field.name in out.columns else F.lit(None)
        out = out.withColumn(field.name, value.cast(field.dataType))
    return out.select(*schemas.CENTROID.fieldNames())


def labelled_spans(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(text, start, end, label, span) of labelled texts: one JSON list, or JSON lines."""
    reader = spark.read.schema(schemas.LABELLED_SPANS).option("multiLine", multi_line)
    return explode_spans(reader.json(path))


def explode_spans(df: DataFrame) -> DataFrame:
    from hazardspark.functions.extract import span_text

    return df.select("text", F.explode("entities").alias("_e")).select(
        "text", F.col("_e.start").alias("start"), F.col("_e.end").alias("end"),
        F.col("_e.label").alias("label"),
        span_text(F.col("text"), F.col("_e.start"), F.col("_e.end")).alias("span"),
    )
