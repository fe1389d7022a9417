"""Sources (S) and sinks (K): files are written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pelagos.plans.adapters import cte, view
from pelagos.plans.catalog import query
from pelagos.plans.correlation import FLAGSHIP_SQL, results
from pelagos.session import shared_dir
from pelagos.sources import readers, sinks

D, B, A = cte("duck", "det"), cte("duck", "detbox"), cte("duck", "ais")


def _path(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("s01_k01_predictions_csv", B + "SELECT detect_id, round(lat, 6) AS lat, round(lon, 6) AS lon, round(confidence, 6) AS confidence, vessel_type, CAST(bbox_x1 AS INTEGER) AS bbox_x1, round(vessel_length_m, 3) AS vessel_length_m FROM detbox")
def predictions(spark, d):
    p = _path(spark, "predictions")
    sinks.write_csv(view(spark, d, "detbox"), p)
    r = readers.read_detections(spark, p)
    return r.select("detect_id", *[F.round(c, 6).alias(c) for c in ("lat", "lon", "confidence")], "vessel_type", "bbox_x1", F.round("vessel_length_m", 3).alias("vessel_length_m"))


@query("s02_s03_ais_csv", A + "SELECT mmsi AS MMSI, round(lat, 4) AS LAT, round(sog, 6) AS SOG, vtype AS VesselType FROM ais")
def ais_csv(spark, d):
    p = _path(spark, "ais")
    a = view(spark, d, "ais")
    sinks.write_csv(a.select(F.col("mmsi").alias("MMSI"), F.timestamp_micros("us").cast("string").alias("BaseDateTime"), F.col("lat").alias("LAT"), F.col("lon").alias("LON"), F.col("sog").alias("SOG"), F.col("vtype").cast("double").alias("VesselType")), p)
    return readers.read_ais(spark, p, True).select("MMSI", F.round("LAT", 4).alias("LAT"), F.round("SOG", 6).alias("SOG"), F.col("VesselType").cast("int").alias("VesselType"))


@query("s04_k11_correlation_csv", f"SELECT detect_id, matched_mmsi, is_dark_ship, round(match_confidence, 5) AS match_confidence FROM ({FLAGSHIP_SQL}) q")
def correlation_csv(spark, d):
    p = _path(spark, "correlation")
    sinks.write_csv(sinks.correlation_csv(results(spark, d)), p)
    return readers.read_correlation(spark, p).select("detect_id", "matched_mmsi", "is_dark_ship", F.round("match_confidence", 5).alias("match_confidence"))


@query("s05_avoid_csv", cte("duck", "avoid") + "SELECT alon, alat, width_m FROM avoid")
def avoid_csv(spark, d):
    p = _path(spark, "avoid")
    sinks.write_csv(view(spark, d, "avoid").select(F.col("alon").cast("double").alias("lon"), F.col("alat").cast("double").alias("lat"), "width_m"), p)
    return readers.read_avoid(spark, p)


@query("s15_p16_p17_acquisition_time", D + """, n AS (SELECT detect_id, CASE WHEN detect_id % 3 = 0 THEN 'scene_without_time' ELSE 'S1A_IW_20230620T23' || lpad(CAST(detect_id % 60 AS VARCHAR), 2, '0') || '42_X' END AS name, CASE WHEN detect_id % 2 = 0 THEN '2023-06-20 23:06:42' END AS manifest FROM det)
SELECT detect_id, epoch_us(coalesce(try_strptime(nullif(regexp_extract(name, '_([0-9]{8}T[0-9]{6})_', 1), ''), '%Y%m%dT%H%M%S'), CAST(manifest AS TIMESTAMP), TIMESTAMP '2023-01-01 00:00:00')) AS us FROM n""")
def times(spark, d):
    k = F.col("detect_id")
    name = F.when(k % 3 == 0, "scene_without_time").otherwise(F.concat(F.lit("S1A_IW_20230620T23"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit("42_X")))
    n = view(spark, d, "det").select("detect_id", name.alias("name"), F.when(k % 2 == 0, "<safe:startTime>2023-06-20T23:06:42.123</safe:startTime>").alias("manifest"))
    t = readers.acquisition_time("name", "manifest", fallback=F.lit("2023-01-01 00:00:00").cast("timestamp_ntz"))
    return n.select("detect_id", F.unix_micros(t.cast("timestamp")).alias("us"))


@query("s17_scene_names", "SELECT c_custkey, split_part(c_name, '#', 2) AS part FROM customer")
def scene_names(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet")
    return c.select("c_custkey", F.coalesce(F.try_element_at(F.split("c_name", "#"), F.lit(2)), F.lit("")).alias("part"))


@query("s22_generated_detections", "SELECT 200 AS n, 200 AS ids, true AS inside")
def generated(spark, d):
    g = readers.generated_detections(spark, 200, (-77.0, 36.0, -75.0, 37.5), 7)
    return g.agg(F.count(F.lit(1)).cast("int").alias("n"), F.count_distinct("detect_id").cast("int").alias("ids"), F.bool_and(F.col("lat").between(36, 37.5) & F.col("lon").between(-77, -75)).alias("inside"))


@query("k02_detection_rows", B + "SELECT round(lon, 6) AS x, round(lat, 6) AS y, round(confidence, 6) AS confidence, [bbox_x1, bbox_y1, bbox_x2, bbox_y2] AS bbox FROM detbox")
def rows(spark, d):
    r = sinks.detection_rows(view(spark, d, "detbox"))
    return r.select(F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), F.round("confidence", 6).alias("confidence"), "bbox")


@query("k03_canonical_columns", D + "SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, vessel_length_m AS length, heading_degrees AS heading, round(confidence, 6) AS confidence, detect_id, scene_id FROM det")
def canonical(spark, d):
    c = sinks.canonical(view(spark, d, "det"))
    return c.withColumns({k: F.round(k, 6) for k in ("lat", "lon", "confidence")})


@query("k05_k09_point_features", D + "SELECT detect_id, 'Point' AS kind, round(lon, 6) AS lon, round(lat, 6) AS lat, round(confidence, 6) AS confidence FROM det")
def point_features(spark, d):
    f = sinks.point_features(view(spark, d, "det"), ["detect_id", "confidence", "vessel_type"])
    j = F.from_json("feature", "type STRING, geometry STRUCT<type: STRING, coordinates: ARRAY<DOUBLE>>, properties STRUCT<confidence: DOUBLE>")
    return f.withColumn("j", j).select("detect_id", F.col("j.geometry.type").alias("kind"), F.col("j.geometry.coordinates")[0].alias("lon"), F.col("j.geometry.coordinates")[1].alias("lat"), F.round("j.properties.confidence", 6).alias("confidence"))


@query("k07_polygon_features", D + "SELECT detect_id, 5 AS corners, coalesce(vessel_length_m, 50e0) AS length, coalesce(vessel_type, 'unknown') AS class, is_fishing_vessel > 0.5e0 AS fishing FROM det")
def polygons(spark, d):
    f = sinks.polygon_features(view(spark, d, "det"))
    j = F.from_json("feature", "geometry STRUCT<coordinates: ARRAY<ARRAY<ARRAY<DOUBLE>>>>, properties STRUCT<length: DOUBLE, class: STRING, fishing: BOOLEAN>")
    return f.withColumn("j", j).select("detect_id", F.size(F.col("j.geometry.coordinates")[0]).alias("corners"), "j.properties.length", "j.properties.class", "j.properties.fishing")


@query("k08_shape_attributes", B + "SELECT detect_id, vessel_length_m AS vessel_len, vessel_width_m AS vessel_wid, vessel_speed_k AS vessel_spe, vessel_type AS vessel_typ, preprocess_row AS preprocess, preprocess_column AS preproces1 FROM detbox")
def shape(spark, d):
    s = view(spark, d, "detbox").select("detect_id", "vessel_length_m", "vessel_width_m", "vessel_speed_k", "vessel_type", "preprocess_row", "preprocess_column")
    return sinks.shape_attributes(s)


@query("k10_correlation_features", f"SELECT detect_id, coalesce(CAST(matched_mmsi AS VARCHAR), 'UNKNOWN') AS mmsi, 'correlated' AS compat, CASE WHEN matched_mmsi IS NULL THEN 'dark_ship' ELSE 'correlated' END AS strict FROM ({FLAGSHIP_SQL}) q")
def correlation_features(spark, d):
    p = lambda c: F.from_json(c, "properties STRUCT<matched_mmsi: STRING, status: STRING>")
    r = results(spark, d).select("detect_id", p(sinks.correlation_feature()).alias("a"), p(sinks.correlation_feature(False)).alias("b"))
    return r.select("detect_id", F.col("a.properties.matched_mmsi").alias("mmsi"), F.col("a.properties.status").alias("compat"), F.col("b.properties.status").alias("strict"))


@query("k12_api_features", B + "SELECT detect_id, unnest(['point', 'box']) AS kind FROM detbox")
def api(spark, d):
    return sinks.api_features(view(spark, d, "detbox")).select("detect_id", "kind")


@query("k13_ais_in_scene", A + ", b AS (SELECT min(lat) AS a, max(lat) AS b, min(lon) AS c, max(lon) AS e FROM (" + D + "SELECT * FROM det) z) SELECT seq, mmsi FROM ais, b WHERE lat BETWEEN b.a AND b.b AND lon BETWEEN b.c AND b.e AND us BETWEEN 1705320000000000 - 86400000000 AND 1705320000000000 + 86400000000")
def in_scene(spark, d):
    from pelagos.operators import filters as L
    near = L.time_window(view(spark, d, "ais"), 1705320000000000, 24)
    return L.within_bounds_of(near, view(spark, d, "det"), 0.0).select("seq", "mmsi")


@query("k14_run_summary", f"SELECT count(*) AS total_detections, count(matched_mmsi) AS correlated, count(*) - count(matched_mmsi) AS dark_ships, round(100e0 * count(matched_mmsi) / count(*), 2) AS match_rate FROM ({FLAGSHIP_SQL}) q")
def summary(spark, d):
    j = F.from_json("summary", "total_detections BIGINT, correlated BIGINT, dark_ships BIGINT, match_rate DOUBLE")
    return sinks.run_summary(results(spark, d)).select(j.alias("j")).select("j.*")


@query("k15_service_payload", D + "SELECT CAST(detect_id AS VARCHAR) AS id, round(lon, 6) AS lon, round(lat, 6) AS lat FROM det")
def payload(spark, d):
    return sinks.service_payload(view(spark, d, "det")).select(F.from_json("payload", "id STRING, lon DOUBLE, lat DOUBLE").alias("j")).select("j.*")
