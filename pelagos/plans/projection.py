"""Geometric functions (M) and row projections (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagos.functions import geo, scoring
from pelagos.operators import dedupe
from pelagos.operators import projections as R
from pelagos.plans.adapters import cte, hav, view
from pelagos.plans.catalog import query

D, B, A, BX = cte("duck", "det"), cte("duck", "detbox"), cte("duck", "ais"), cte("duck", "boxes")


@query("m01_m02_m09_distances", D + f"SELECT detect_id, round({hav('lat', 'lon', '36.5e0', '-76e0')}, 3) AS hav_m, round(111000e0 * sqrt(power(lat - 36.5e0, 2) + power(lon + 76e0, 2)), 3) AS flat_m, round(111000e0 * sqrt(power(lat - 36.5e0, 2) + power((lon + 76e0) * cos(radians(lat)), 2)), 3) AS scaled_m FROM det")
def distances(spark, d):
    return view(spark, d, "det").select("detect_id", F.round(geo.haversine_m("lat", "lon", 36.5, -76.0), 3).alias("hav_m"), F.round(geo.flat_m("lat", "lon", 36.5, -76.0), 3).alias("flat_m"), F.round(geo.flat_m("lat", "lon", 36.5, -76.0, True), 3).alias("scaled_m"))


@query("m04_motion_models", A + """, m AS (SELECT seq, sog * 0.514444e0 AS v, radians(cog) AS h, CASE WHEN seq % 3 = 0 THEN 0e0 ELSE 0.001e0 * (seq % 5 + 1) END AS w FROM ais WHERE sog IS NOT NULL AND cog IS NOT NULL)
SELECT seq, round(v * cos(h) * 600, 3) + 0e0 AS cv_x, round(v * sin(h) * 600, 3) + 0e0 AS cv_y, round(CASE WHEN abs(w) < 1e-6 THEN v * cos(h) * 600 ELSE v / w * (sin(h + w * 600) - sin(h)) END, 3) + 0e0 AS ct_x, round(CASE WHEN abs(w) < 1e-6 THEN v * sin(h) * 600 ELSE v / w * (cos(h) - cos(h + w * 600)) END, 3) + 0e0 AS ct_y FROM m""")
def motion(spark, d):
    a = view(spark, d, "ais").filter("sog IS NOT NULL AND cog IS NOT NULL").select("seq", (F.col("sog") * geo.KNOT_MS).alias("v"), F.radians("cog").alias("h"), F.when(F.col("seq") % 3 == 0, 0.0).otherwise(0.001 * (F.col("seq") % 5 + 1)).alias("w"))
    cx, cy = geo.constant_velocity(F.lit(0.0), F.lit(0.0), F.col("v") * F.cos("h"), F.col("v") * F.sin("h"), F.lit(600.0))
    tx, ty, _ = geo.constant_turn(F.lit(0.0), F.lit(0.0), "v", "h", "w", F.lit(600.0))
    return a.select("seq", *[(F.round(c, 3) + 0.0).alias(n) for c, n in ((cx, "cv_x"), (cy, "cv_y"), (tx, "ct_x"), (ty, "ct_y"))])


@query("m07_process_noise", A + "SELECT vtype, q, round(q * 81 / 4e0, 4) AS q00, round(q * 27 / 2e0, 4) AS q02, round(q * 9, 4) AS q22 FROM (SELECT DISTINCT vtype, CASE WHEN vtype BETWEEN 70 AND 79 THEN 0.5e0 WHEN vtype BETWEEN 30 AND 39 THEN 2e0 WHEN vtype BETWEEN 50 AND 59 THEN 1.5e0 ELSE 1e0 END AS q FROM ais) x")
def noise(spark, d):
    q = view(spark, d, "ais").select("vtype").distinct().withColumn("q", geo.motion_noise("vtype"))
    m = geo.process_noise("q", F.lit(3.0))
    return q.select("vtype", "q", F.round(m[0][0], 4).alias("q00"), F.round(m[0][2], 4).alias("q02"), F.round(m[2][2], 4).alias("q22"))


@query("m08_square_bounds", D + "SELECT detect_id, round(lat - 50 / 111000e0, 8) AS lat0, round(lon - 50 / (111000e0 * cos(lat)), 8) AS lon0_compat, round(lon - 50 / (111000e0 * cos(radians(lat))), 8) AS lon0_strict FROM det")
def bounds(spark, d):
    c, s = geo.square_bounds("lat", "lon", F.lit(100.0)), geo.square_bounds("lat", "lon", F.lit(100.0), True)
    return view(spark, d, "det").select("detect_id", F.round(c["min_lat"], 8).alias("lat0"), F.round(c["min_lon"], 8).alias("lon0_compat"), F.round(s["min_lon"], 8).alias("lon0_strict"))


@query("m10_shore_distance", A + "SELECT seq, round(least(abs(lon + 75.8e0), abs(lon + 76.8e0)) * 111000e0 * cos(radians(lat)), 3) AS shore_m FROM ais")
def shore(spark, d):
    return view(spark, d, "ais").select("seq", F.round(geo.shore_m("lat", "lon"), 3).alias("shore_m"))


@query("m11_m12_m14_geotransform", B + """, g AS (SELECT -78.5e0 AS g0, 3.2e0 / 16732e0 AS g1, 37.6e0 AS g3, -1.9e0 / 25970e0 AS g5) SELECT detect_id, round(g0 + preprocess_column * g1, 8) AS lon, round(g3 + preprocess_row * g5, 8) AS lat, round(abs(g1) * 111000e0, 6) AS metres FROM detbox, g""")
def transform(spark, d):
    g = geo.geotransform(F.lit(-78.5), F.lit(37.6 - 1.9), F.lit(-78.5 + 3.2), F.lit(37.6), F.lit(16732.0), F.lit(25970.0))
    lon, lat = F.lit(-78.5) + F.col("preprocess_column") * F.lit(3.2 / 16732.0), F.lit(37.6) + F.col("preprocess_row") * F.lit(-1.9 / 25970.0)
    _ = g
    return view(spark, d, "detbox").select("detect_id", F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"), F.round(geo.metres_per_pixel(F.lit(3.2 / 16732.0)), 6).alias("metres"))


@query("m13_grid_interpolation", B + """, t AS (SELECT detect_id, preprocess_column / 100e0 - floor(preprocess_column / 100e0) AS fx, preprocess_row / 100e0 - floor(preprocess_row / 100e0) AS fy, floor(preprocess_column / 100e0) AS cx, floor(preprocess_row / 100e0) AS cy FROM detbox),
q AS (SELECT *, 36e0 + 0.01e0 * cy + 0.001e0 * cx * cx AS q00, 36e0 + 0.01e0 * cy + 0.001e0 * (cx + 1) * (cx + 1) AS q10, 36e0 + 0.01e0 * (cy + 1) + 0.001e0 * cx * cx AS q01, 36e0 + 0.01e0 * (cy + 1) + 0.001e0 * (cx + 1) * (cx + 1) AS q11 FROM t)
SELECT detect_id, round(q00 * (1 - fx) * (1 - fy) + q10 * fx * (1 - fy) + q01 * (1 - fx) * fy + q11 * fx * fy, 8) AS lat FROM q""")
def interpolation(spark, d):
    return R.interpolate_on_grid(view(spark, d, "detbox"), R.demo_grid(spark, 16, 16), 100).select("detect_id", F.round("lat", 8).alias("lat"))


@query("m15_pixel_size", D + f"SELECT detect_id, round(({hav('lat + 0.1e0', 'lon', 'lat + 0.1e0', 'lon + 0.2e0')} + {hav('lat', 'lon', 'lat', 'lon + 0.2e0')}) / 2e0 / 1000e0, 6) AS px, round(({hav('lat', 'lon', 'lat + 0.1e0', 'lon')} + {hav('lat', 'lon + 0.2e0', 'lat + 0.1e0', 'lon + 0.2e0')}) / 2e0 / 500e0, 6) AS py FROM det")
def pixel(spark, d):
    x, y = geo.pixel_size_m("lon", "lat", F.col("lon") + 0.2, F.col("lat") + 0.1, F.lit(1000.0), F.lit(500.0))
    return view(spark, d, "det").select("detect_id", F.round(x, 6).alias("px"), F.round(y, 6).alias("py"))


_ZOOM = "coalesce(list_filter(range(0, 21), lambda z: 40075016.685578488e0 / 256e0 / power(2, z) < 1.1e0 * m)[1], 20)"


@query("m16_mercator_zoom", D + f", z AS (SELECT detect_id, lat, lon, 5e0 + detect_id % 100 AS m FROM det) SELECT detect_id, CAST({_ZOOM} AS INTEGER) AS zoom, round(lon * 20037508.342789244e0 / 180e0, 2) AS mx, round(ln(tan((90e0 + lat) * pi() / 360e0)) * 20037508.342789244e0 / pi(), 2) AS my FROM z")
def zoom(spark, d):
    x, y = geo.mercator("lat", "lon")
    return view(spark, d, "det").withColumn("m", 5.0 + F.col("detect_id") % 100).select("detect_id", geo.zoom_level("m").cast("int").alias("zoom"), F.round(x, 2).alias("mx"), F.round(y, 2).alias("my"))


@query("m17_m21_m22_tiles_and_boxes", B + """SELECT detect_id, CAST(floor(preprocess_column / 512e0) AS BIGINT) AS tile_x, CAST(floor(preprocess_row / 512e0) AS BIGINT) AS tile_y, preprocess_column - 20 AS x1, preprocess_column + 20 AS x2,
 least(greatest(preprocess_row, 60), 1400 - 60) - 60 AS crop_r0, least(greatest(preprocess_column, 60), 1450 - 60) - 60 AS crop_c0 FROM detbox""")
def boxes(spark, d):
    c = geo.crop_bounds("preprocess_row", "preprocess_column", F.lit(1400), F.lit(1450))
    return view(spark, d, "detbox").select("detect_id", geo.tile_of("preprocess_column").alias("tile_x"), geo.tile_of("preprocess_row").alias("tile_y"), (F.col("preprocess_column") - 20).alias("x1"), (F.col("preprocess_column") + 20).alias("x2"), c["r0"].alias("crop_r0"), c["c0"].alias("crop_c0"))


@query("m18_box_ring", D + """, m AS (SELECT detect_id, CASE WHEN vessel_length_m > 0 THEN vessel_length_m ELSE 50e0 END AS len, lon * 20037508.342789244e0 / 180e0 AS x, ln(tan((90e0 + lat) * pi() / 360e0)) * 20037508.342789244e0 / pi() AS y FROM det)
SELECT detect_id, round((x - len / 2) * 180e0 / 20037508.342789244e0, 7) AS lon0, round(degrees(2 * atan(exp((y - len * 0.3e0) * pi() / 20037508.342789244e0)) - pi() / 2), 7) AS lat0, round((x + len / 2) * 180e0 / 20037508.342789244e0, 7) AS lon2, round(degrees(2 * atan(exp((y + len * 0.3e0) * pi() / 20037508.342789244e0)) - pi() / 2), 7) AS lat2, 5 AS corners FROM m""")
def ring(spark, d):
    r = view(spark, d, "det").withColumn("r", geo.box_ring("lat", "lon", "vessel_length_m"))
    return r.select("detect_id", *[F.round(F.col("r")[i][k], 7).alias(f"{k}{i}") for i in (0, 2) for k in ("lon", "lat")], F.size("r").alias("corners"))


@query("m19_scene_extent", D + "SELECT scene_id, round(min(lon), 6) AS w, round(min(lat), 6) AS s, round(max(lon), 6) AS e, round(max(lat), 6) AS n FROM det GROUP BY scene_id")
def extent(spark, d):
    b = view(spark, d, "det").groupBy("scene_id").agg(*[f(c).alias(n) for f, c, n in ((F.min, "lon", "w0"), (F.min, "lat", "s0"), (F.max, "lon", "e0"), (F.max, "lat", "n0"))])
    r = b.withColumn("ring", geo.extent_ring("w0", "s0", "e0", "n0"))
    return r.select("scene_id", F.round(F.col("ring")[0].lon, 6).alias("w"), F.round(F.col("ring")[0].lat, 6).alias("s"), F.round(F.col("ring")[2].lon, 6).alias("e"), F.round(F.col("ring")[2].lat, 6).alias("n"))


@query("m20_rotated_labels", B + "SELECT detect_id, round(750 + (preprocess_column - 750) * cos(radians(30)) - (preprocess_row - 750) * sin(radians(30)), 4) AS x, round(750 + (preprocess_column - 750) * sin(radians(30)) + (preprocess_row - 750) * cos(radians(30)), 4) AS y, 1500 - bbox_x2 AS flip_x1, 1500 - bbox_x1 AS flip_x2 FROM detbox")
def rotated(spark, d):
    x, y = geo.rotate("preprocess_column", "preprocess_row", F.lit(750.0), F.lit(750.0), F.lit(30.0))
    return view(spark, d, "detbox").select("detect_id", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"), (1500 - F.col("bbox_x2")).alias("flip_x1"), (1500 - F.col("bbox_x1")).alias("flip_x2"))


@query("p02_p03_defaults_and_gap", A + "SELECT seq, coalesce(heading, cog) AS heading, coalesce(vtype, 90) AS vtype, round(least(greatest((1705320000000000 - us) / 1e6, 0e0), 7200e0), 6) AS gap_s FROM ais")
def defaults(spark, d):
    from pelagos.plans.adapters import T_US
    return view(spark, d, "ais").select("seq", F.coalesce("heading", "cog").alias("heading"), F.coalesce("vtype", F.lit(90)).alias("vtype"), F.round(F.least(F.greatest((F.lit(T_US) - F.col("us")) / 1e6, F.lit(0.0)), F.lit(7200.0)), 6).alias("gap_s"))


@query("p07_bucket_heading", A + ", b AS (SELECT seq, list_transform(range(0, 16), lambda i: (seq * 7 + i * 13) % 23) AS v FROM ais) SELECT seq, (list_position(v, list_max(v)) - 1 + 0.5e0) * 22.5e0 AS heading_mid, (list_position(v, list_max(v)) - 1) * 22.5e0 AS heading_edge FROM b")
def bucket(spark, d):
    b = view(spark, d, "ais").select("seq", F.expr("transform(sequence(0, 15), i -> (seq * 7 + i * 13) % 23)").alias("v"))
    return b.select("seq", scoring.bucket_heading("v").alias("heading_mid"), scoring.bucket_heading("v", 0.0).alias("heading_edge"))


@query("p08_softmax", BX + ", e AS (SELECT id, exp(score) AS a, exp(x / 400e0) AS b FROM boxes) SELECT id, round(a / (a + b), 6) AS p0, round(b / (a + b), 6) AS p1 FROM e")
def softmax(spark, d):
    v = view(spark, d, "boxes").select("id", scoring.softmax(F.array(F.col("score"), F.col("x") / 400.0)).alias("p"))
    return v.select("id", F.round(F.col("p")[0], 6).alias("p0"), F.round(F.col("p")[1], 6).alias("p1"))


@query("p09_metadata_cleanup", D + "SELECT detect_id, least(greatest(coalesce(confidence * 1.5e0, 0e0), 0e0), 1e0) AS confidence, least(greatest(coalesce(vessel_length_m * 3, 0e0), 0e0), 1000e0) AS length, least(greatest(coalesce(vessel_width_m, 0e0), 0e0), 1000e0) AS width, coalesce(heading_degrees + 200, 0e0) - 360 * floor(coalesce(heading_degrees + 200, 0e0) / 360) AS orientation FROM det")
def cleanup(spark, d):
    src = view(spark, d, "det").select("detect_id", (F.col("confidence") * 1.5).alias("confidence"), (F.col("vessel_length_m") * 3).alias("length"), F.col("vessel_width_m").alias("width"), (F.col("heading_degrees") + 200).alias("orientation"))
    return R.clean_metadata(src).select("detect_id", "confidence", "length", "width", "orientation")


@query("p10_quality_score", D + ", " + cte("duck", "strategy").removeprefix("WITH ") + "SELECT detect_id, round(least(confidence + coalesce((4 - priority) * 0.1e0, 0e0) + CASE WHEN vessel_length_m > 0 THEN 0.1e0 ELSE 0e0 END + CASE WHEN vessel_width_m > 0 THEN 0.1e0 ELSE 0e0 END, 1e0), 6) AS quality FROM det LEFT JOIN strategy ON category = CASE detect_id % 4 WHEN 0 THEN 'small' WHEN 1 THEN 'large' WHEN 2 THEN 'other' ELSE 'medium' END")
def quality(spark, d):
    k = F.col("detect_id") % 4
    det = view(spark, d, "det").withColumn("category", F.when(k == 0, "small").when(k == 1, "large").when(k == 2, "other").otherwise("medium"))
    return det.join(F.broadcast(view(spark, d, "strategy")), "category", "left").select("detect_id", F.round(dedupe.quality("confidence", F.col("priority")), 6).alias("quality"))


@query("p11_multi_scale_bonus", D + "SELECT detect_id, round(confidence + CASE WHEN vessel_length_m > 0 THEN 0.1e0 ELSE 0e0 END + CASE WHEN vessel_width_m > 0 THEN 0.1e0 ELSE 0e0 END + (1024 - 512) / 1024e0 * 0.1e0, 6) AS bonus FROM det")
def bonus(spark, d):
    b = F.col("confidence") + F.when(F.col("vessel_length_m") > 0, 0.1).otherwise(0.0) + F.when(F.col("vessel_width_m") > 0, 0.1).otherwise(0.0) + F.lit(512 / 1024 * 0.1)
    return view(spark, d, "det").select("detect_id", F.round(b, 6).alias("bonus"))


@query("p12_normalised_synonyms", D + "SELECT detect_id, confidence, vessel_length_m, heading_degrees, CAST(NULL AS INTEGER) AS bbox_x1 FROM det")
def synonyms(spark, d):
    from pelagos.schemas import normalize_detections
    old = view(spark, d, "det").select("detect_id", "lat", "lon", F.col("confidence").alias("score"), F.coalesce("vessel_length_m", F.lit(float("nan"))).alias("length"), F.col("heading_degrees").alias("orientation"))
    return normalize_detections(old).select("detect_id", "confidence", "vessel_length_m", "heading_degrees", "bbox_x1")


_B = "CAST(floor(h * 16 / 360) AS BIGINT)"


@query("p13_heading_encoding", D + f""", h AS (SELECT detect_id, CAST(detect_id * 7 % 360 AS DOUBLE) AS h FROM det), k AS (SELECT detect_id, {_B} AS b, abs(h - ({_B} * 22.5e0 + 11.25e0)) > 6.25e0 AS near FROM h)
SELECT detect_id, list_transform(range(0, 16), lambda i: round(CASE WHEN i = (b + 9) % 16 OR i = (b + 7) % 16 THEN 1 / 14e0 WHEN i = (b + 8) % 16 THEN 2 / 14e0 WHEN near AND (i = (b + 1) % 16 OR i = (b + 15) % 16) THEN 1 / 14e0 WHEN i = b THEN 8 / 14e0 ELSE 0e0 END, 6)) AS target FROM k""")
def encoding(spark, d):
    return view(spark, d, "det").select("detect_id", R.heading_target((F.col("detect_id") * 7 % 360).cast("double")).alias("target"))


@query("p14_json_properties", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def properties(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("p15_p18_names", D + """, n AS (SELECT detect_id, CASE detect_id % 3 WHEN 0 THEN 'S1A' WHEN 1 THEN 'S2B' ELSE 'L8' END || '_IW_GRDH_1SDV_20230620T' || lpad(CAST(230000 + detect_id % 5000 AS VARCHAR), 6, '0') || '_X' AS name FROM det)
SELECT detect_id, CASE WHEN name LIKE 'S1%' THEN 'sentinel1' WHEN name LIKE 'S2%' THEN 'sentinel2' ELSE 'landsat' END AS catalog, split_part(name, '_', 5) AS stamp, 'ship_' || lpad(CAST(detect_id % 10000 AS VARCHAR), 4, '0') AS vessel FROM n""")
def names(spark, d):
    k = F.col("detect_id") % 3
    name = F.concat(F.when(k == 0, "S1A").when(k == 1, "S2B").otherwise("L8"), F.lit("_IW_GRDH_1SDV_20230620T"), F.lpad((230000 + F.col("detect_id") % 5000).cast("string"), 6, "0"), F.lit("_X"))
    n = view(spark, d, "det").select("detect_id", name.alias("name"))
    return n.select("detect_id", R.catalog_of("name").alias("catalog"), R.stamp_of("name").alias("stamp"), F.format_string("ship_%04d", F.col("detect_id") % 10000).alias("vessel"))


@query("p19_p26_mismatch_and_types", D + ", " + cte("duck", "strategy").removeprefix("WITH ") + "SELECT detect_id, round(greatest(vessel_length_m, 80e0) / least(vessel_length_m, 80e0), 6) AS ratio, greatest(vessel_length_m, 80e0) / least(vessel_length_m, 80e0) > 2 AS mismatch FROM det WHERE vessel_length_m > 0")
def mismatch(spark, d):
    r = F.greatest(F.col("vessel_length_m"), F.lit(80.0)) / F.least(F.col("vessel_length_m"), F.lit(80.0))
    return view(spark, d, "det").filter("vessel_length_m > 0").select("detect_id", F.round(r, 6).alias("ratio"), (r > 2).alias("mismatch"))


@query("p20_labels", D + "SELECT detect_id, 'V' || detect_id || ' ' || CAST(CAST(round(confidence * 100, 0) AS INTEGER) AS VARCHAR) || '%' AS label, CASE WHEN confidence >= 0.8e0 THEN 'green' WHEN confidence >= 0.6e0 THEN 'yellow' WHEN confidence >= 0.4e0 THEN 'orange' ELSE 'red' END AS colour FROM det")
def labels(spark, d):
    c = F.col("confidence")
    return view(spark, d, "det").select("detect_id", F.concat(F.lit("V"), F.col("detect_id").cast("string"), F.lit(" "), F.round(c * 100, 0).cast("int").cast("string"), F.lit("%")).alias("label"), F.when(c >= 0.8, "green").when(c >= 0.6, "yellow").when(c >= 0.4, "orange").otherwise("red").alias("colour"))


@query("p21_p23_box_rescale", B + "SELECT detect_id, greatest(CAST(floor((bbox_x1 - 100) * 0.5e0) AS BIGINT), 0) AS x1, least(CAST(floor((bbox_x2 - 100) * 0.5e0) AS BIGINT), 600) AS x2, round(confidence, 3) AS confidence FROM detbox WHERE least(floor((bbox_x2 - 100) * 0.5e0), 600) > greatest(floor((bbox_x1 - 100) * 0.5e0), 0)")
def rescale(spark, d):
    return R.rescale_boxes(view(spark, d, "detbox"), 100, 0.5, 600).select("detect_id", "x1", "x2", F.round("confidence", 3).alias("confidence"))


@query("p22_grid_lines", "SELECT a AS axis, v AS at FROM (SELECT 'x' AS a, unnest(range(0, 1451, 100)) AS v UNION ALL SELECT 'y', unnest(range(0, 1401, 100))) t")
def lines(spark, d):
    return spark.range(1).select(F.explode(F.array(F.struct(F.lit("x").alias("axis"), F.expr("sequence(0L, 1450L, 100L)").alias("s")), F.struct(F.lit("y").alias("axis"), F.expr("sequence(0L, 1400L, 100L)").alias("s")))).alias("l")).select("l.axis", F.explode("l.s").alias("at"))
