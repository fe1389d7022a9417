"""Joins (J), greedy suppression, assignment, clusters, set operations (U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagos.functions import geo
from pelagos.operators import assign, cluster, dedupe, spatial, tracks
from pelagos.plans.adapters import cte, hav, view
from pelagos.plans.catalog import query
from pelagos.plans.correlation import FLAGSHIP_SQL, results

D, B, TR, BX = cte("duck", "det"), cte("duck", "detbox"), cte("duck", "truth"), cte("duck", "boxes")
_P = "det.detect_id AS a, e.detect_id AS b"


@query("j02_detections_with_results", f"SELECT d.detect_id, d.vessel_length_m, q.matched_mmsi, q.match_confidence FROM ({D} SELECT * FROM det) d LEFT JOIN ({FLAGSHIP_SQL}) q ON q.detect_id = d.detect_id")
def with_results(spark, d):
    return view(spark, d, "det").select("detect_id", "vessel_length_m").join(results(spark, d).select("detect_id", "matched_mmsi", "match_confidence"), "detect_id", "left")


@query("j03_results_with_truth", f"SELECT q.detect_id, q.matched_mmsi, t.seq, t.vtype FROM ({FLAGSHIP_SQL}) q LEFT JOIN ({TR} SELECT * FROM truth) t ON CAST(t.mmsi AS VARCHAR) = CAST(q.matched_mmsi AS VARCHAR)")
def with_truth(spark, d):
    t = view(spark, d, "truth").select(F.col("mmsi").cast("string").alias("m"), "seq", "vtype")
    q = results(spark, d).select("detect_id", "matched_mmsi")
    return q.join(t, F.col("matched_mmsi").cast("string") == F.col("m"), "left").drop("m")


@query("j04_j06_semi_anti_mark", f"SELECT t.mmsi, t.mmsi IN (SELECT matched_mmsi FROM ({FLAGSHIP_SQL}) q WHERE matched_mmsi IS NOT NULL) AS found FROM ({TR} SELECT * FROM truth) t")
def mark(spark, d):
    t, q = view(spark, d, "truth").select("mmsi"), results(spark, d).filter("matched_mmsi IS NOT NULL").select(F.col("matched_mmsi").alias("mmsi"))
    return t.join(q, "mmsi", "left_semi").withColumn("found", F.lit(True)).union(t.join(q, "mmsi", "left_anti").withColumn("found", F.lit(False)))


@query("j09_near_coordinate_pairs", D + f"SELECT {_P} FROM det JOIN det e ON det.detect_id < e.detect_id WHERE abs(det.lat - e.lat) < 0.002e0 AND abs(det.lon - e.lon) < 0.002e0")
def near_pairs(spark, d):
    p = view(spark, d, "det").select("detect_id", "lat", "lon")
    on = (F.col("detect_id_a") < F.col("detect_id_b")) & (F.abs(F.col("lat_a") - F.col("lat_b")) < 0.002) & (F.abs(F.col("lon_a") - F.col("lon_b")) < 0.002)
    return spatial.cell_join(spatial.renamed(p, "_a"), spatial.renamed(p, "_b"), "lat_a", "lon_a", "lat_b", "lon_b", 0.002, 0.002, on).select(F.col("detect_id_a").alias("a"), F.col("detect_id_b").alias("b"))


_IOU = "greatest(least(a.bbox_x2, b.bbox_x2) - greatest(a.bbox_x1, b.bbox_x1), 0) * greatest(least(a.bbox_y2, b.bbox_y2) - greatest(a.bbox_y1, b.bbox_y1), 0)"
_IOU = f"({_IOU}) / CAST((a.bbox_x2 - a.bbox_x1) * (a.bbox_y2 - a.bbox_y1) + (b.bbox_x2 - b.bbox_x1) * (b.bbox_y2 - b.bbox_y1) - ({_IOU}) AS DOUBLE)"


@query("j10_m05_iou_pairs", B + f"SELECT a.detect_id AS a, b.detect_id AS b, round({_IOU}, 6) AS iou FROM detbox a JOIN detbox b ON a.detect_id < b.detect_id WHERE {_IOU} > 0.3e0")
def iou_pairs(spark, d):
    p = view(spark, d, "detbox").select("detect_id", "bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2")
    box = ("bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2")
    over = geo.iou(*[c + "_a" for c in box], *[c + "_b" for c in box])
    return spatial.box_pairs(p, "detect_id", over > 0.3).select(F.col("detect_id_a").alias("a"), F.col("detect_id_b").alias("b"), F.round(over, 6).alias("iou"))


@query("j11_similar_attributes", D + f"SELECT {_P} FROM det JOIN det e ON det.detect_id < e.detect_id WHERE abs(det.vessel_length_m - e.vessel_length_m) < 60 AND abs(det.vessel_width_m - e.vessel_width_m) < 20 AND abs(det.lat - e.lat) < 0.02e0 AND abs(det.lon - e.lon) < 0.02e0")
def similar(spark, d):
    p = view(spark, d, "det").select("detect_id", "lat", "lon", "vessel_length_m", "vessel_width_m").na.drop()
    c = lambda n: F.abs(F.col(n + "_a") - F.col(n + "_b"))
    on = (F.col("detect_id_a") < F.col("detect_id_b")) & (c("vessel_length_m") < 60) & (c("vessel_width_m") < 20) & (c("lat") < 0.02) & (c("lon") < 0.02)
    return spatial.cell_join(spatial.renamed(p, "_a"), spatial.renamed(p, "_b"), "lat_a", "lon_a", "lat_b", "lon_b", 0.02, 0.02, on).select(F.col("detect_id_a").alias("a"), F.col("detect_id_b").alias("b"))


@query("j12_a17_pair_distances", D + """, p AS (SELECT 111000e0 * sqrt(power(x.lat - y.lat, 2) + power(x.lon - y.lon, 2)) AS m FROM det x JOIN det y ON x.detect_id < y.detect_id)
SELECT count(*) AS pairs, round(min(m), 3) AS min_m, round(avg(m), 3) AS avg_m, round(max(m), 3) AS max_m, round(median(m), 3) AS median_m, count(CASE WHEN m < 100 THEN 1 END) AS under_100, count(CASE WHEN m < 500 THEN 1 END) AS under_500 FROM p""")
def pair_distances(spark, d):
    """All pairs of all detections: aggregates, and the median by selection."""
    m = spatial.all_pairs(view(spark, d, "det").select("detect_id", "lat", "lon"), "detect_id").select(geo.flat_m("lat_a", "lon_a", "lat_b", "lon_b").alias("m"))
    s = m.agg(F.count(F.lit(1)).alias("pairs"), F.min("m").alias("lo"), F.avg("m").alias("mean"), F.max("m").alias("hi"), F.count_if(F.col("m") < 100).alias("under_100"), F.count_if(F.col("m") < 500).alias("under_500")).first()
    middle = spatial.quantiles(m, "m", [0.5])[0]
    r = spark.createDataFrame([(s.pairs, s.lo, s.mean, s.hi, middle, s.under_100, s.under_500)], "pairs long, min_m double, avg_m double, max_m double, median_m double, under_100 long, under_500 long")
    return r.select(*[F.round(c, 3).alias(c) if c.endswith("_m") else F.col(c) for c in r.columns])


@query("j13_labels_of_dataset", cte("duck", "windows", "labels") + "SELECT value, count(*) AS n, round(sum(length), 2) AS total FROM labels WHERE window_id IN (SELECT id FROM windows WHERE dataset_id = 7 AND split IN ('train', 'val')) GROUP BY value")
def labels_of(spark, d):
    w = view(spark, d, "windows").filter(F.col("dataset_id").eqNullSafe(7) & F.col("split").isin("train", "val")).select(F.col("id").alias("window_id"))
    return view(spark, d, "labels").join(w, "window_id", "left_semi").groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("length"), 2).alias("total"))


@query("j14_nearest_report", cte("duck", "det", "pred72") + f"SELECT detect_id, round(min({hav('det.lat', 'det.lon', 'plat', 'plon')}), 3) AS nearest_m FROM (SELECT * FROM det ORDER BY detect_id LIMIT 10) det, pred72 GROUP BY detect_id")
def nearest_report(spark, d):
    """The ten detections are a stated set of queries; each meets every report."""
    a = view(spark, d, "det").orderBy("detect_id").limit(10).select("detect_id", "lat", "lon")
    b = view(spark, d, "pred72").select("plat", "plon")
    return b.crossJoin(F.broadcast(a)).groupBy("detect_id").agg(F.round(F.min(geo.haversine_m("lat", "lon", "plat", "plon")), 3).alias("nearest_m"))


@query("j15_m02_coast_distance", TR + ", " + cte("duck", "coast").removeprefix("WITH ") + f"SELECT mmsi, round(min({hav('lat', 'lon', 'clat', 'clon')}), 3) AS min_distance FROM truth, coast GROUP BY mmsi")
def coast(spark, d):
    t = view(spark, d, "truth").select("mmsi", "lat", "lon")
    return spatial.nearest_point(t, view(spark, d, "coast"), geo.haversine_m("lat", "lon", "clat", "clon", asin=True), "mmsi").select("mmsi", F.round("min_distance", 3).alias("min_distance"))


@query("j18_distance_nms", BX + """, s AS (SELECT id, scene_id, x, y, row_number() OVER (PARTITION BY scene_id ORDER BY score DESC, id) AS rk FROM boxes WHERE is_gt = 0),
k AS (SELECT * FROM (WITH RECURSIVE g(scene_id, rk, kept) AS (SELECT DISTINCT scene_id, CAST(0 AS BIGINT), []::BIGINT[] FROM s UNION ALL
  SELECT s.scene_id, s.rk, CASE WHEN EXISTS (SELECT 1 FROM s o WHERE o.scene_id = s.scene_id AND list_contains(g.kept, o.id) AND sqrt(power(o.x - s.x, 2) + power(o.y - s.y, 2)) <= 15e0) THEN g.kept ELSE list_append(g.kept, s.id) END
  FROM g JOIN s ON s.scene_id = g.scene_id AND s.rk = g.rk + 1) SELECT scene_id, arg_max(kept, rk) AS kept FROM g GROUP BY scene_id))
SELECT unnest(kept) AS id FROM k""")
def nms(spark, d):
    r = view(spark, d, "boxes").filter("is_gt = 0").select("id", "scene_id", "x", "y", "score")
    return dedupe.distance_nms(r, 15.0, group="scene_id").select("id")


@query("j19_iou_nms", B + f""", s AS (SELECT detect_id AS id, confidence, bbox_x1, bbox_y1, bbox_x2, bbox_y2, row_number() OVER (ORDER BY confidence DESC, detect_id) AS rk FROM detbox),
k AS (SELECT * FROM (WITH RECURSIVE g(rk, kept) AS (SELECT CAST(0 AS BIGINT), []::BIGINT[] UNION ALL
  SELECT b.rk, CASE WHEN EXISTS (SELECT 1 FROM s a WHERE list_contains(g.kept, a.id) AND {_IOU} > 0.2e0) THEN g.kept ELSE list_append(g.kept, b.id) END FROM g JOIN s b ON b.rk = g.rk + 1) SELECT kept FROM g ORDER BY rk DESC LIMIT 1))
SELECT unnest(kept) AS id FROM k""")
def box_nms(spark, d):
    r = view(spark, d, "detbox").select(F.col("detect_id").alias("id"), "confidence", "bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2")
    return dedupe.iou_nms(r, 0.2, score="confidence").select("id")


@query("j20_j25_quality_merge")
def merge(spark, d):
    s = view(spark, d, "strategy")
    det = view(spark, d, "det").withColumn("category", F.when(F.col("vessel_length_m") < 60, "small").when(F.col("vessel_length_m") > 150, "large").otherwise("medium"))
    rows = det.join(F.broadcast(s), "category", "left").select(F.col("detect_id").alias("id"), "lon", "lat", F.col("confidence").alias("score"), dedupe.quality("confidence", F.col("priority")).alias("quality"), "vessel_length_m", "vessel_width_m", "vessel_speed_k")
    m = dedupe.weighted_merge(rows, 0.002)
    return m.select("id", *[F.round(c, 6).alias(c) for c in ("lon", "lat", "score", "vessel_length_m", "vessel_width_m", "vessel_speed_k")], "members")


@query("j21_multi_scale_merge")
def scales(spark, d):
    r = view(spark, d, "detbox").select(F.col("detect_id").alias("id"), F.col("preprocess_row").cast("double").alias("px_row"), F.col("preprocess_column").cast("double").alias("px_col"), F.col("confidence").alias("score"),
                                        F.when(F.col("detect_id") % 3 == 0, 30.0).otherwise(50.0).alias("threshold"), "vessel_length_m", "vessel_width_m", F.when(F.col("detect_id") % 2 == 0, 512).otherwise(1024).alias("window_size"))
    return dedupe.multi_scale_merge(r, most=50.0)


@query("j22_optimal_assignment")
def optimal(spark, d):
    from pelagos.operators import correlate as K
    p = view(spark, d, "pred72").withColumn("minutes", F.col("gap_s") / 60).withColumn("uncertainty_m", F.lit(0.0))
    pairs = K.choose_all(K.scored(K.candidates(view(spark, d, "det"), p)))
    return assign.one_to_one(pairs, 0.5).select("detect_id", "mmsi", F.round("total", 6).alias("total"))


@query("j23_a24_point_matching")
def points(spark, d):
    b = view(spark, d, "boxes")
    c = assign.match_points(b.filter("is_gt = 1"), b.filter("is_gt = 0"))
    return c


@query("a24_scene_metrics")
def metrics(spark, d):
    b = view(spark, d, "boxes")
    t = assign.match_points(b.filter("is_gt = 1"), b.filter("is_gt = 0")).agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    ok, tp = F.col("tp") > 0, F.col("tp").cast("double")
    p, r = tp / (F.col("tp") + F.col("fp")), tp / (F.col("tp") + F.col("fn"))
    return t.select("tp", "fp", "fn", *[F.when(ok, F.round(x, 6)).otherwise(0.0).alias(n) for x, n in ((p, "precision"), (r, "recall"), (2 * p * r / (p + r), "f1"))])


@query("j24_box_matching")
def boxes(spark, d):
    b = view(spark, d, "boxes").selectExpr("id", "scene_id", "is_gt", "x - 12 AS x1", "y - 12 AS y1", "x + 12 AS x2", "y + 12 AS y2")
    return assign.match_boxes(b.filter("is_gt = 1"), b.filter("is_gt = 0"))


@query("j26_first_match_lookup", cte("duck", "ais") + f"SELECT q.detect_id, q.matched_mmsi, f.seq FROM ({FLAGSHIP_SQL}) q JOIN (SELECT mmsi, min(seq) AS seq FROM ais GROUP BY mmsi) f ON f.mmsi = q.matched_mmsi")
def lookup(spark, d):
    first = view(spark, d, "ais").groupBy("mmsi").agg(F.min("seq").alias("seq"))
    q = results(spark, d).select("detect_id", "matched_mmsi")
    return q.join(first, q.matched_mmsi == first.mmsi).select("detect_id", "matched_mmsi", "seq")


@query("j27_grid_index", B + ", q AS (SELECT * FROM (VALUES (1, 100, 100, 300, 250), (2, 700, 700, 701, 1500)) AS t(q, qx1, qy1, qx2, qy2)) SELECT DISTINCT q, detect_id FROM q, detbox WHERE floor(bbox_x1 / 64e0) <= floor(qx2 / 64e0) AND floor(bbox_x2 / 64e0) >= floor(qx1 / 64e0) AND floor(bbox_y1 / 64e0) <= floor(qy2 / 64e0) AND floor(bbox_y2 / 64e0) >= floor(qy1 / 64e0)")
def grid(spark, d):
    index = spatial.grid_index(view(spark, d, "detbox").select("detect_id", "bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2"), ("bbox_x1", "bbox_x2"), ("bbox_y1", "bbox_y2"), 64)
    q = spark.sql("SELECT * FROM VALUES (1, 100, 100, 300, 250), (2, 700, 700, 701, 1500) AS t(q, qx1, qy1, qx2, qy2)")
    return spatial.grid_search(index, q, "detect_id", 64)


_SEG = cte("duck", "ais") + ", l AS (SELECT mmsi, us, seq, lat, lon, us - lag(us) OVER (PARTITION BY mmsi ORDER BY us, seq) AS gap FROM ais), g AS (SELECT *, sum(CASE WHEN gap > 86400000000 THEN 1 ELSE 0 END) OVER (PARTITION BY mmsi ORDER BY us, seq) AS segment FROM l) "


@query("j28_w05_track_segments", _SEG + "SELECT mmsi, CAST(segment AS BIGINT) AS segment, count(*) AS points, min(us) AS first_us, max(us) AS last_us FROM g GROUP BY mmsi, segment")
def track_segments(spark, d):
    return tracks.segments(view(spark, d, "ais"), 86_400).groupBy("mmsi", "segment").agg(F.count(F.lit(1)).alias("points"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))


@query("w07_interpolated_tracks", _SEG + """, n AS (SELECT *, lead(us) OVER w AS us2, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM g WINDOW w AS (PARTITION BY mmsi, segment ORDER BY us, seq)),
s AS (SELECT mmsi, us, us2, lat, lon, lat2, lon2, unnest(range((us // 3600000000 + 1) * 3600000000, us2, 3600000000)) AS at_us FROM n WHERE us2 > us)
SELECT mmsi, at_us, round(lat + (lat2 - lat) * (at_us - us) / CAST(us2 - us AS DOUBLE), 6) AS lat, round(lon + (lon2 - lon) * (at_us - us) / CAST(us2 - us AS DOUBLE), 6) AS lon FROM s""")
def interpolated(spark, d):
    t = tracks.interpolate(tracks.segments(view(spark, d, "ais"), 86_400), 3600)
    return t.select("mmsi", F.col("at").alias("at_us"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("a33_interpolation_rmse", cte("duck", "ais") + f"""SELECT round(sqrt(avg(m * m)), 2) AS rmse_m, count(*) AS points FROM (SELECT {hav('lat', 'lon', 'lat0 + (lat2 - lat0) * f', 'lon0 + (lon2 - lon0) * f')} AS m FROM
 (SELECT *, (us - us0) / CAST(us2 - us0 AS DOUBLE) AS f FROM (SELECT lat, lon, us, lag(us) OVER w AS us0, lead(us) OVER w AS us2, lag(lat) OVER w AS lat0, lead(lat) OVER w AS lat2, lag(lon) OVER w AS lon0, lead(lon) OVER w AS lon2 FROM ais WINDOW w AS (PARTITION BY mmsi ORDER BY us, seq)) x WHERE us2 > us0) y) z""")
def rmse(spark, d):
    return tracks.leave_one_out_rmse(view(spark, d, "ais")).select(F.round("rmse_m", 2).alias("rmse_m"), "points")


@query("r13_dbscan", TR + """, p AS (SELECT mmsi, lat, lon FROM truth), n AS (SELECT a.mmsi AS a, b.mmsi AS b FROM p a JOIN p b ON sqrt(power(a.lat - b.lat, 2) + power(a.lon - b.lon, 2)) <= 0.06e0),
c AS (SELECT a FROM n GROUP BY a HAVING count(*) >= 3), e AS (SELECT n.a, n.b FROM n JOIN c x ON x.a = n.a JOIN c y ON y.a = n.b),
k AS (SELECT * FROM (WITH RECURSIVE r(id, lab) AS (SELECT a, a FROM c UNION SELECT e.b, r.lab FROM r JOIN e ON e.a = r.id) SELECT id, min(lab) AS lab FROM r GROUP BY id)),
b AS (SELECT n.a AS id, min(k.lab) AS lab FROM n JOIN k ON k.id = n.b GROUP BY n.a)
SELECT p.mmsi AS id, coalesce(k.lab, b.lab, -1) AS cluster FROM p LEFT JOIN k ON k.id = p.mmsi LEFT JOIN b ON b.id = p.mmsi""")
def clusters(spark, d):
    p = view(spark, d, "truth").select(F.col("mmsi").alias("id"), F.col("lon").alias("x"), F.col("lat").alias("y"))
    return cluster.dbscan(p, 0.06)


@query("r02_water_regions")
def water(spark, d):
    r = cluster.regions(view(spark, d, "cells").filter("water = 1").select("cx", "cy"), 64)
    return cluster.region_stats(r).select("component", "area", "x0", "x1", "y0", "y1")


@query("u01_u02_vessel_sets", f"""SELECT s AS part, count(*) AS n FROM (SELECT CASE WHEN a.m IS NULL THEN 'extra' WHEN b.m IS NULL THEN 'missed' ELSE 'found' END AS s FROM (SELECT DISTINCT CAST(mmsi AS VARCHAR) AS m FROM ({TR} SELECT * FROM truth)) a
 FULL JOIN (SELECT DISTINCT CAST(matched_mmsi AS VARCHAR) AS m FROM ({FLAGSHIP_SQL}) q WHERE matched_mmsi IS NOT NULL) b ON a.m = b.m) x GROUP BY s""")
def sets(spark, d):
    t = view(spark, d, "truth").select(F.col("mmsi").cast("string").alias("m"))
    q = results(spark, d).filter("matched_mmsi IS NOT NULL").select(F.col("matched_mmsi").cast("string").alias("m"))
    parts = (("found", t.intersect(q)), ("missed", t.subtract(q)), ("extra", q.subtract(t)))
    out = None
    for n, df in parts:
        one = df.select(F.lit(n).alias("part"))
        out = one if out is None else out.union(one)
    return out.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("u03_u04_union_distinct", B + "SELECT strategy, count(*) AS n, count(DISTINCT r) AS offsets FROM (SELECT 'small' AS strategy, preprocess_row // 256 AS r FROM detbox WHERE preprocess_row % 2 = 0 UNION ALL SELECT 'large', preprocess_row // 512 FROM detbox) x GROUP BY strategy")
def union(spark, d):
    b = view(spark, d, "detbox")
    a = b.filter("preprocess_row % 2 = 0").select(F.lit("small").alias("strategy"), F.expr("preprocess_row div 256").alias("r"))
    c = b.select(F.lit("large").alias("strategy"), F.expr("preprocess_row div 512").alias("r"), F.lit(1).alias("only_here"))
    return a.unionByName(c, allowMissingColumns=True).groupBy("strategy").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("r").alias("offsets"))


@query("u05_first_per_uuid", cte("duck", "images") + "SELECT uuid, id FROM (SELECT uuid, id, row_number() OVER (PARTITION BY uuid ORDER BY id) AS rn FROM images) x WHERE rn = 1")
def first_uuid(spark, d):
    return view(spark, d, "images").groupBy("uuid").agg(F.min("id").alias("id"))
