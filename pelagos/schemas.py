"""Fixed schemas of the four tables, and the normalisation of detections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(spec: str) -> T.StructType:
    kinds = {"l": T.LongType(), "d": T.DoubleType(), "s": T.StringType(), "i": T.IntegerType(), "b": T.BooleanType(), "t": T.TimestampNTZType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (c.split(":") for c in spec.split())])


BUCKETS = " ".join(f"heading_bucket_{i}:d" for i in range(16))
DETECTIONS = _schema("detect_id:l lat:d lon:d confidence:d preprocess_row:d preprocess_column:d bbox_x1:i bbox_y1:i bbox_x2:i bbox_y2:i timestamp:t vessel_length_m:d vessel_width_m:d vessel_speed_k:d is_fishing_vessel:d vessel_type:s heading_degrees:d " + BUCKETS)
OLD_DETECTIONS = _schema("preprocess_row:d preprocess_column:d lon:d lat:d score:d vessel_length_m:d vessel_width_m:d " + BUCKETS + " vessel_speed_k:d is_fishing_vessel:d column:l row:l orientation:i meters_per_pixel:d detect_id:s scene_id:s")
AIS = _schema("MMSI:l BaseDateTime:t LAT:d LON:d SOG:d COG:d Heading:d VesselName:s IMO:s CallSign:s VesselType:d Status:d Length:d Width:d Draft:d Cargo:d TransceiverClass:s")
CORRELATION = _schema("detect_id:l lat:d lon:d confidence:d matched_mmsi:s match_confidence:d time_gap_minutes:d distance_meters:d position_score:d heading_score:d size_score:d speed_score:d type_score:d temporal_score:d is_dark_ship:b is_ambiguous:b")
AVOID = _schema("lon:d lat:d width_m:d")
TRACKS = _schema("mmsi:l timestamp:t point_type:s lat:d lon:d speed:d course:d")

#: Column names that mean the same, the first is ours.
SYNONYMS = {
    "confidence": ("confidence", "score"), "vessel_length_m": ("vessel_length_m", "length"), "vessel_width_m": ("vessel_width_m", "width"),
    "heading_degrees": ("heading_degrees", "heading", "orientation"), "vessel_type": ("vessel_type", "class", "type"),
}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark orders NaN above all numbers and finds NaN > 1 true, so it must go before any comparison."""
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def normalize_detections(df: DataFrame, schema: T.StructType = DETECTIONS) -> DataFrame:
    """All columns of `schema` in its order: synonyms coalesced, missing ones null, NaN null,
    is_fishing_vessel a probability whether it came as one or as a boolean."""
    have = {c.lower(): c for c in df.columns}
    kinds = dict(df.dtypes)
    out = []
    for f in schema.fields:
        names = [have[n] for n in SYNONYMS.get(f.name, (f.name,)) if n in have]
        cols = [F.col(n).cast("int").cast(f.dataType) if kinds[n] == "boolean" else F.col(n).cast(f.dataType) for n in names]
        out.append((F.coalesce(*cols) if cols else F.lit(None).cast(f.dataType)).alias(f.name))
    return nan_to_null(df.select(*out))
