"""Sources: CSV layouts, product XML, names, raw bands, generated detections, configuration."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagos import schemas
from pelagos.operators.projections import stamp_of, stamp_time


def _csv(spark: SparkSession, path: str, schema, sep: str = ",", order: bool = False) -> DataFrame:
    """Header CSV by name: the file's columns may be a part of the schema or in another order.
    order adds file_order, which grows along each file, and from file to file by name."""
    head = spark.read.option("header", True).option("sep", sep).csv(path)
    have = {c.lower(): c for c in head.columns}
    cols = []
    for f in schema.fields:
        if f.name.lower() not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.trim(F.col(f"`{have[f.name.lower()]}`"))
        c = F.nullif(c, F.lit(""))
        kind = f.dataType.simpleString()
        if kind in ("bigint", "int"):
            # 90.0 is a whole number too; long ids don't go through DOUBLE
            cols.append(F.expr(f"coalesce(try_cast({_sql(have[f.name.lower()])} AS {kind}), try_cast(try_cast({_sql(have[f.name.lower()])} AS DOUBLE) AS {kind}))").alias(f.name))
        elif kind == "string":
            cols.append(c.alias(f.name))
        else:
            cols.append(F.expr(f"try_cast(nullif(trim({_sql(have[f.name.lower()])}), '') AS {kind})").alias(f.name))
    if order:
        cols.append(F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("file_order"))
    return schemas.nan_to_null(head.select(*cols))


def _sql(name: str) -> str:
    return f"`{name}`"


def read_detections(spark: SparkSession, path: str, old_layout: bool = False) -> DataFrame:
    """Predictions in the current or the older layout, normalised to the current schema."""
    return schemas.normalize_detections(_csv(spark, path, schemas.OLD_DETECTIONS if old_layout else schemas.DETECTIONS))


def read_ais(spark: SparkSession, path: str, drop_incomplete: bool = False) -> DataFrame:
    df = _csv(spark, path, schemas.AIS, order=True)
    return df.na.drop(subset=["LAT", "LON", "MMSI"]) if drop_incomplete else df


def ais_columns(df: DataFrame) -> DataFrame:
    """The names that the operators take. seq is the place in the files: of a vessel's reports
    equally near in time the first one counts. Without file_order it is a hash of the report."""
    us = F.unix_micros(F.col("BaseDateTime").cast("timestamp"))
    return df.select((F.col("file_order") if "file_order" in df.columns else F.xxhash64("MMSI", "BaseDateTime", "LAT", "LON")).alias("seq"), F.col("MMSI").alias("mmsi"), us.alias("us"), F.col("LAT").alias("lat"), F.col("LON").alias("lon"), F.col("SOG").alias("sog"), F.col("COG").alias("cog"), F.col("Heading").alias("heading"),
                     F.col("Length").alias("length"), F.col("Width").alias("width"), F.col("VesselType").cast("int").alias("vtype"))


def read_correlation(spark: SparkSession, path: str) -> DataFrame:
    """Results with the sentinel 'UNKNOWN' as null."""
    return _csv(spark, path, schemas.CORRELATION).withColumn("matched_mmsi", F.expr("try_cast(nullif(matched_mmsi, 'UNKNOWN') AS BIGINT)"))


def read_avoid(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.AVOID).select(F.col("lon").alias("alon"), F.col("lat").alias("alat"), "width_m")


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.TRACKS)


def read_pins(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated vector data whose comments begin with #."""
    return spark.read.option("header", True).option("sep", "\t").option("comment", "#").csv(path)


def read_geolocation_grid(spark: SparkSession, path: str) -> DataFrame:
    """Nodes (line, pixel, latitude, longitude) of a product annotation."""
    x = spark.read.format("xml").option("rowTag", "geolocationGridPoint").schema("line DOUBLE, pixel DOUBLE, latitude DOUBLE, longitude DOUBLE").load(path)
    return x.select((F.col("pixel") / 1).alias("cx"), (F.col("line") / 1).alias("cy"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))


def read_footprint(spark: SparkSession, path: str) -> DataFrame:
    """Bounds of the coordinates in a KML or manifest: 'lon,lat lon,lat ...'."""
    text = spark.read.option("wholetext", True).text(path).select(F.regexp_extract("value", r"<(?:gml:)?coordinates>([^<]*)<", 1).alias("c"))
    pts = text.select(F.explode(F.split(F.trim("c"), r"\s+")).alias("p")).select(F.split("p", ",")[0].cast("double").alias("lon"), F.split("p", ",")[1].cast("double").alias("lat"))
    return pts.agg(F.min("lon").alias("min_lon"), F.min("lat").alias("min_lat"), F.max("lon").alias("max_lon"), F.max("lat").alias("max_lat"))


def acquisition_time(name: str, manifest: str | None = None, annotation: str | None = None, fallback: Column | None = None) -> Column:
    """First of: the time in the folder's name, in the manifest, in the annotation, the fallback."""
    parts = [stamp_time(stamp_of(name))]
    for col, tag in ((manifest, "startTime"), (annotation, "(?:productFirstLineUtcTime|startTime)")):
        if col:
            parts.append(F.try_to_timestamp(F.nullif(F.substring(F.regexp_extract(col, rf"<[^>]*{tag}[^>]*>([^<]+)<", 1), 1, 19), F.lit("")), F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz"))
    return F.coalesce(*parts, *([fallback] if fallback is not None else []))


def scene_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files under a folder with the parts of their names; contents aren't read."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "modificationTime", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return f.withColumn("name", name).withColumn("parts", F.split(F.regexp_replace("name", r"\.[^.]*$", ""), "_")).withColumn("channel", F.try_element_at("parts", F.lit(3)))


def envi_header(text: str) -> dict:
    """The fields of an ENVI header that place its samples."""
    out = {}
    for line in text.splitlines():
        k, eq, v = line.partition("=")
        if eq:
            out[k.strip().lower()] = v.strip()
    return {"samples": int(out["samples"]), "lines": int(out["lines"]), "type": int(out.get("data type", 4)), "big": out.get("byte order", "1") == "1"}


def read_band_tiles(spark: SparkSession, path: str, header: str, side: int = 512) -> DataFrame:
    """A raw band as tiles (path, tile_row, tile_col, height, width, payload float32). Every strip of
    `side` lines is read by its own byte range, so a file of any size spreads over tasks."""
    from pelagos.sources.images import _open

    h = envi_header(header)
    kind = np.dtype({1: "u1", 2: "i2", 3: "i4", 4: "f4", 5: "f8", 12: "u2"}[h["type"]]).newbyteorder(">" if h["big"] else "<")
    schema = "path string, tile_row long, tile_col long, height int, width int, payload binary"
    strips = -(-h["lines"] // side)

    def read(batches):
        for b in batches:
            for p, at in zip(b.column("path").to_pylist(), b.column("strip").to_pylist()):
                n = min(side, h["lines"] - at * side)
                with _open(p) as file:
                    raw = file.read_at(n * h["samples"] * kind.itemsize, at * side * h["samples"] * kind.itemsize)
                a = np.frombuffer(raw, kind).reshape(n, h["samples"])
                rows = [(p, at, c // side, n, min(side, h["samples"] - c), a[:, c:c + side].astype("<f4").tobytes()) for c in range(0, h["samples"], side)]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=[f.split()[0] for f in schema.split(", ")])

    files = spark.read.format("binaryFile").load(path).select("path")  # names alone, no contents
    return files.select("path", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip")).repartition("path", "strip").mapInArrow(read, schema)


def dimap_bands(spark: SparkSession, path: str) -> DataFrame:
    """Band names, sizes and data files of a DIMAP product header."""
    text = spark.read.option("wholetext", True).text(path)
    def all_of(tag: str) -> Column:
        return F.expr(f"xpath(value, '//Spectral_Band_Info/{tag}/text()')")
    z = text.select(F.explode(F.arrays_zip(all_of("BAND_NAME").alias("name"), all_of("BAND_RASTER_WIDTH").alias("width"), all_of("BAND_RASTER_HEIGHT").alias("height"))).alias("b"))
    return z.select("b.name", F.col("b.width").cast("int").alias("width"), F.col("b.height").cast("int").alias("height"))


def generated_detections(spark: SparkSession, n: int, bounds: tuple[float, float, float, float], seed: int = 0) -> DataFrame:
    """n detections spread over (lon0, lat0, lon1, lat1); the same for the same seed."""
    def u(k: int) -> Column:
        return (F.pmod(F.xxhash64("id", F.lit(seed * 1000 + k)), F.lit(1 << 30)) / float(1 << 30))
    lon0, lat0, lon1, lat1 = bounds
    return spark.range(n).select(F.format_string("vessel_%04d", "id").alias("detect_id"), (lat0 + u(1) * (lat1 - lat0)).alias("lat"), (lon0 + u(2) * (lon1 - lon0)).alias("lon"), (0.5 + u(3) / 2).alias("confidence"), (10 + u(4) * 290).alias("vessel_length_m"), (u(5) * 360).alias("heading_degrees"))


@dataclass
class Config:
    """Settings by dotted name, from a JSON file and PELAGOS_ variables of the environment."""
    values: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | None = None) -> Config:
        values: dict = {}
        if path:
            with open(path, encoding="utf-8") as f:
                text = f.read()
            if path.endswith((".yml", ".yaml")):
                import yaml  # only where it is installed
                values = yaml.safe_load(text) or {}
            else:
                values = json.loads(text)
        out = cls(values)
        for k, v in os.environ.items():
            if k.startswith("PELAGOS_SET_"):
                out.put(k.removeprefix("PELAGOS_SET_").lower().replace("__", "."), v)
        return out

    def get(self, name: str, default=None):
        at = self.values
        for part in name.split("."):
            if not isinstance(at, dict) or part not in at:
                return default
            at = at[part]
        return at

    def put(self, name: str, value) -> None:
        *head, last = name.split(".")
        at = self.values
        for part in head:
            at = at.setdefault(part, {})
        at[last] = value
