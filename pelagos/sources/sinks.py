"""Sinks: CSV layouts, GeoJSON and JSON as columns, attribute tables, summaries."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagos.functions import geo

CANONICAL = ("lat", "lon", "length", "heading", "confidence", "detect_id", "scene_id", "meters_per_pixel")
SHAPE_COLUMNS, SHAPE_NAME = 20, 10


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def canonical(df: DataFrame) -> DataFrame:
    """The canonical columns that exist, in order; synonyms count."""
    names = {"length": ("length", "vessel_length_m"), "heading": ("heading", "heading_degrees", "orientation"), "confidence": ("confidence", "score")}
    out = []
    for c in CANONICAL:
        have = [n for n in names.get(c, (c,)) if n in df.columns]
        if have:
            out.append(F.col(have[0]).alias(c))
    return df.select(*out)


def detection_rows(df: DataFrame) -> DataFrame:
    """x, y, confidence and box of each detection, as in the JSON document."""
    return df.select(F.col("lon").alias("x"), F.col("lat").alias("y"), "confidence", F.array("bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2").alias("bbox"))


def write_detections_json(df: DataFrame, path: str, metadata: dict) -> None:
    """One JSON object a line, and the metadata beside it; a document of all rows would have to
    meet in one task."""
    detection_rows(df).write.mode("overwrite").json(f"{path}/detections")
    n = df.agg(F.count(F.lit(1)).alias("total_detections"))
    n.select("*", *[F.lit(v).alias(k) for k, v in metadata.items()]).write.mode("overwrite").json(f"{path}/metadata")


def point(lon: str = "lon", lat: str = "lat") -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(F.round(lon, 6), F.round(lat, 6)).alias("coordinates"))


def polygon(ring: Column) -> Column:
    return F.struct(F.lit("Polygon").alias("type"), F.array(F.transform(ring, lambda p: F.array(F.round(p.lon, 7), F.round(p.lat, 7)))).alias("coordinates"))


def feature(geometry: Column, properties: Column) -> Column:
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties")))


def point_features(df: DataFrame, properties: list[str]) -> DataFrame:
    """A GeoJSON feature a row; rows without coordinates are skipped."""
    return df.filter("lat IS NOT NULL AND lon IS NOT NULL").select("detect_id", feature(point(), F.struct(*properties)).alias("feature"))


def polygon_features(df: DataFrame) -> DataFrame:
    """Boxes by length (50 m where it is missing), with defaulted properties."""
    props = F.struct(F.coalesce("vessel_length_m", F.lit(50.0)).alias("length"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("vessel_type", F.lit("unknown")).alias("class"), (F.coalesce("is_fishing_vessel", F.lit(0.0)) > 0.5).alias("fishing"))
    return df.filter("lat IS NOT NULL AND lon IS NOT NULL").select("detect_id", feature(polygon(geo.box_ring("lat", "lon", "vessel_length_m")), props).alias("feature"))


def correlation_feature(compat: bool = True) -> Column:
    """compat finds every row correlated, as its file spells a missing vessel 'UNKNOWN'."""
    status = F.lit("correlated") if compat else F.when(F.col("matched_mmsi").isNotNull(), "correlated").otherwise("dark_ship")
    return feature(point(), F.struct("detect_id", F.coalesce(F.col("matched_mmsi").cast("string"), F.lit("UNKNOWN")).alias("matched_mmsi"), F.round("match_confidence", 4).alias("match_confidence"), status.alias("status")))


def correlation_features(df: DataFrame, compat: bool = True) -> DataFrame:
    return df.select("detect_id", correlation_feature(compat).alias("feature"))


def api_features(df: DataFrame) -> DataFrame:
    """Two features a row: the point, and the pixel box."""
    box = F.struct(F.lit("Polygon").alias("type"), F.array(F.array(*[F.array(F.col(f"bbox_{a}").cast("double"), F.col(f"bbox_{b}").cast("double")) for a, b in (("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2"), ("x1", "y1"))])).alias("coordinates"))
    both = F.array(F.struct(F.lit("point").alias("kind"), F.to_json(point()).alias("geometry")), F.struct(F.lit("box").alias("kind"), F.to_json(box).alias("geometry")))
    return df.select("detect_id", F.explode(both).alias("f")).select("detect_id", "f.kind", "f.geometry")


def correlation_csv(df: DataFrame) -> DataFrame:
    return df.withColumn("matched_mmsi", F.coalesce(F.col("matched_mmsi").cast("string"), F.lit("UNKNOWN")))


def shape_attributes(df: DataFrame) -> DataFrame:
    """Names of at most ten characters, made different by a number, and at most twenty columns."""
    used: set[str] = set()
    out = []
    for c in df.columns[:SHAPE_COLUMNS]:
        name, n = c[:SHAPE_NAME], 0
        while name.lower() in used:
            n += 1
            name = c[:SHAPE_NAME - len(str(n))] + str(n)
        used.add(name.lower())
        out.append(F.col(c).alias(name))
    return df.select(*out)


def _shape(xs: list[float], ys: list[float], names: list[str], rows: list[list[str]]) -> tuple[bytes, bytes, bytes]:
    """.shp, .shx and .dbf of points with text attributes."""
    n = len(xs)
    bounds = struct.pack("<dddddddd", min(xs, default=0), min(ys, default=0), max(xs, default=0), max(ys, default=0), 0, 0, 0, 0)

    def head(size: int) -> bytes:
        return struct.pack(">iiiiiii", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<ii", 1000, 1) + bounds
    shp = head(100 + 28 * n) + b"".join(struct.pack(">ii", i, 10) + struct.pack("<idd", 1, x, y) for i, (x, y) in enumerate(zip(xs, ys), 1))
    shx = head(100 + 8 * n) + b"".join(struct.pack(">ii", 50 + 14 * i, 10) for i in range(n))
    cells = [[v.encode("utf-8")[:254] for v in r] for r in rows]
    wide = [max([1, *(len(r[k]) for r in cells)]) for k in range(len(names))]
    dbf = struct.pack("<BBBBIHH20x", 3, 100, 1, 1, n, 33 + 32 * len(names), 1 + sum(wide))
    dbf += b"".join(struct.pack("<11scIBB14x", k.encode()[:SHAPE_NAME], b"C", 0, w, 0) for k, w in zip(names, wide)) + b"\r"
    return shp, shx, dbf + b"".join(b" " + b"".join(v.ljust(w) for v, w in zip(r, wide)) for r in cells) + b"\x1a"


def shape_files(df: DataFrame, most: int = 100_000) -> DataFrame:
    """Point shapefiles with attributes: a row (points, shp, shx, dbf) for every `most` points of a
    task at most, so a table of any size gives as many files as it needs. Rows without
    coordinates are skipped."""
    names = shape_attributes(df).columns
    rows = df.filter("lon IS NOT NULL AND lat IS NOT NULL").select(F.col("lon").cast("double"), F.col("lat").cast("double"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns[:len(names)]])

    def task(batches):
        xs, ys, held = [], [], []

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array([len(xs)], pa.int64()), *[pa.array([b], pa.binary()) for b in _shape(xs, ys, names, held)]], names=["points", "shp", "shx", "dbf"])
            for part in (xs, ys, held):
                part.clear()
            return out
        for b in batches:
            for x, y, *rest in zip(*(c.to_pylist() for c in b.columns)):
                xs.append(x)
                ys.append(y)
                held.append(rest)
                if len(xs) == most:
                    yield flush()
        if xs:
            yield flush()

    return rows.toDF("x", "y", *names).mapInArrow(task, "points long, shp binary, shx binary, dbf binary")


def shape_points(df: DataFrame) -> bytes:
    """The .shp of the points of a report: 100 000 rows come to the driver at most; shape_files()
    writes any number."""
    rows = df.select("lon", "lat").na.drop().limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("over 100 000 points don't come to the driver; shape_files() gives several files")
    return _shape([r.lon for r in rows], [r.lat for r in rows], [], [[] for _ in rows])[0]


def run_summary(results: DataFrame) -> DataFrame:
    """One row of JSON with counts and rates."""
    a = results.agg(F.count(F.lit(1)).alias("total_detections"), F.count("matched_mmsi").alias("correlated"), F.count_if(F.col("matched_mmsi").isNull()).alias("dark_ships"), F.round(100.0 * F.count("matched_mmsi") / F.count(F.lit(1)), 2).alias("match_rate"))
    return a.select(F.to_json(F.struct("*")).alias("summary"))


def service_payload(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(F.col("detect_id").cast("string").alias("id"), F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))).alias("payload"))


def export_all(df: DataFrame, path: str) -> dict[str, str]:
    """CSV and GeoJSON lines of the canonical columns; the status of each form."""
    status = {}
    for name, write in (("csv", lambda p: write_csv(canonical(df), p)), ("geojson", lambda p: point_features(df, [c for c in ("detect_id", "confidence", "vessel_type") if c in df.columns]).select("feature").write.mode("overwrite").text(p))):
        write(f"{path}/{name}")
        status[name] = f"{path}/{name}"
    return status
