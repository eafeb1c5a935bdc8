"""Table shapes. Every source declares one of these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

VICTIMS = ["fatalities", "injured", "evacuated", "displaced", "missing"]


def _fields(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in cols.items()])


S, I, L, D, DT, TS = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(), T.TimestampType(),
)

RAW_ARTICLE = _fields(ID=S, keyword=S, localidade=S, title=S, link=S, published=S, collection_date=S)

ARTICLE = _fields(
    ID=S, title=S, type=S, subtype=S, date=S, year=I, month=I, day=I, hour=S, georef=S,
    district=S, municipali=S, parish=S, DICOFREG=S, source=S, sourcedate=S, sourcetype=S, page=S,
    fatalities=I, injured=I, evacuated=I, displaced=I, missing=I,
)

FILTERED_ARTICLE = T.StructType(
    ARTICLE.fields
    + _fields(
        ml_relevance_score=D, relevance_score=I, matched_categories=T.ArrayType(S), evento_nome=S
    ).fields
)

EVENT = _fields(
    id=S, type=S, subtype=S, date=DT, year=I, month=I, day=I, hour=S, latitude=D, longitude=D,
    georef_class=S, district=S, municipality=S, parish=S, dicofreg=S, fatalities=I, injured=I,
    evacuated=I, displaced=I, missing=I, source_name=S, source_date=DT, source_type=S, page=S,
    location_geom=S, updated_at=TS,
)

DISASTERS = _fields(id=L, type=S, subtype=S, date=DT, year=I, month=I, day=I, hour=S)
LOCATION = _fields(
    id=L, latitude=D, longitude=D, georef_class=I, district=S, municipality=S, parish=S,
    dicofreg=S, geom=S,
)
HUMAN_IMPACTS = _fields(id=L, fatalities=I, injured=I, evacuated=I, displaced=I, missing=I)
INFORMATION_SOURCES = _fields(disaster_id=L, source_name=S, source_date=DT, source_type=S, page=S)

CENTROID = _fields(
    latitude=D, longitude=D, name=S, region=S, distrito=S, concelho=S, freguesia=S, dicofre=S,
    area_ha=D, cluster_id=I, centroid_type=S,
)

FORECAST = _fields(
    data=DT, year=I, month=I, type=S, ocorrencias=L, confidence_lower=L, confidence_upper=L,
    model_r2=D, model_mae=D,
)

FEATURE_PAGE = _fields(
    features=T.ArrayType(
        _fields(
            attributes=_fields(
                Natureza=S, DataInicioOcorrencia=S, DataOcorrencia=L, DataDosDados=L,
                Latitude=D, Longitude=D, Concelho=S, Freguesia=S, DICOFRE=S,
            )
        )
    )
)

LABELLED_SPANS = _fields(
    text=S, entities=T.ArrayType(_fields(start=I, end=I, label=S))
)

GAZETTEER_BY_PROVINCE = T.MapType(S, T.MapType(S, T.ArrayType(S)))
GAZETTEER_BY_DISTRICT = T.MapType(S, T.ArrayType(S))
PARISH_CODES = T.MapType(S, T.MapType(S, T.ArrayType(_fields(nome=S, codigo=S))))

RUN_STATS = _fields(
    table_name=S, status=S, input_rows=L, exported_rows=L, run_date=DT, recorded_at=TS,
)

# CSV projections (fixed values: column order of the exchange files).
ARTICLE_CSV = [f for f in ARTICLE.fieldNames() if f != "title"]
DISASTER_READY_CSV = [
    "ID", "title", "date", "type", "subtype", "district", "municipali", "parish", "dicofreg",
    "hour", "source", "link_extraido", "fatalities", "injured", "evacuated", "displaced",
    "missing", "sourcetype",
]


def staging_type(name: str, numeric_codes: bool = False) -> T.DataType:
    """Staging column type from the column name alone; a parish code is text unless ``numeric_codes``."""
    if name in VICTIMS or name in ("year", "month", "day"):
        return T.IntegerType()
    if name == "relevance_score" or name == "DICOFREG" and numeric_codes:
        return T.FloatType()
    return T.StringType()


# Columns refreshed when a staged row meets an existing event.
STAGING_UPDATE_COLS = ["type", "subtype", "date", *VICTIMS]
