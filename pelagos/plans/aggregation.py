"""Aggregations (A), analytic functions (W), sorts and top-k (T)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pelagos.operators import analytics as N
from pelagos.operators import correlate as K
from pelagos.plans.adapters import T_US, cte, view
from pelagos.plans.catalog import query
from pelagos.plans.correlation import FLAGSHIP_SQL, results

D, B, TR, BX, A = cte("duck", "det"), cte("duck", "detbox"), cte("duck", "truth"), cte("duck", "boxes"), cte("duck", "ais")
_SIZE = "CASE WHEN {0} > 100 THEN 'Large' WHEN {0} >= 50 THEN 'Medium' WHEN {0} IS NULL THEN 'Unknown' ELSE 'Small' END"
_SPEED = "CASE WHEN {0} <= 0.5e0 THEN 'stationary' WHEN {0} <= 2 THEN 'very_slow' WHEN {0} <= 5 THEN 'slow' WHEN {0} > 5 THEN 'moving' END"


@query("a06_a07_summary", D + "SELECT round(min(lat), 6) AS min_lat, round(max(lat), 6) AS max_lat, round(min(lon), 6) AS min_lon, round(max(lon), 6) AS max_lon, round(min(confidence), 6) AS min_c, round(max(confidence), 6) AS max_c, round(avg(confidence), 6) AS avg_c, round(avg(vessel_length_m), 4) AS avg_l, count(vessel_length_m) AS n_l FROM det")
def summary(spark, d):
    r = lambda f, c, n, k: F.round(f(c), k).alias(n)
    return view(spark, d, "det").agg(r(F.min, "lat", "min_lat", 6), r(F.max, "lat", "max_lat", 6), r(F.min, "lon", "min_lon", 6), r(F.max, "lon", "max_lon", 6), r(F.min, "confidence", "min_c", 6), r(F.max, "confidence", "max_c", 6), r(F.avg, "confidence", "avg_c", 6), r(F.avg, "vessel_length_m", "avg_l", 4), F.count("vessel_length_m").alias("n_l"))


@query("a08_value_counts", A + "SELECT vtype, count(*) AS n FROM ais WHERE vtype IS NOT NULL GROUP BY vtype ORDER BY n DESC, vtype LIMIT 5")
def value_counts(spark, d):
    return N.value_counts(view(spark, d, "ais"), "vtype", 5)


@query("a09_distinct_vessels", A + f"SELECT count(DISTINCT mmsi) AS all_vessels, count(DISTINCT CASE WHEN us BETWEEN {T_US} - 7200000000 AND {T_US} + 7200000000 THEN mmsi END) AS in_time, count(DISTINCT CASE WHEN lat BETWEEN 36.2e0 AND 37.4e0 THEN mmsi END) AS in_space FROM ais")
def distinct(spark, d):
    return view(spark, d, "ais").agg(F.count_distinct("mmsi").alias("all_vessels"), F.count_distinct(F.when(F.col("us").between(T_US - 7_200_000_000, T_US + 7_200_000_000), F.col("mmsi"))).alias("in_time"), F.count_distinct(F.when(F.col("lat").between(36.2, 37.4), F.col("mmsi"))).alias("in_space"))


@query("a10_mean_closest_gap", A + f"SELECT round(avg(g), 4) AS mean_gap_s, count(*) AS vessels FROM (SELECT mmsi, min(abs(us - {T_US})) / 1e6 AS g FROM ais GROUP BY mmsi) x")
def closest(spark, d):
    g = view(spark, d, "ais").groupBy("mmsi").agg((F.min(F.abs(F.col("us") - T_US)) / 1e6).alias("g"))
    return g.agg(F.round(F.avg("g"), 4).alias("mean_gap_s"), F.count(F.lit(1)).alias("vessels"))


@query("a11_describe", A + "SELECT round(avg(length), 4) AS mean, median(length) AS p50, round(stddev_samp(length), 4) AS std, min(length) AS lo, max(length) AS hi FROM ais")
def describe(spark, d):
    return view(spark, d, "ais").agg(F.round(F.avg("length"), 4).alias("mean"), F.percentile("length", 0.5).alias("p50"), F.round(F.stddev_samp("length"), 4).alias("std"), F.min("length").alias("lo"), F.max("length").alias("hi"))


@query("a12_p04_p05_classes", A + f"SELECT {_SIZE.format('length')} AS size_class, {_SPEED.format('sog')} AS speed_class, count(*) AS n, round(100e0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM ais GROUP BY 1, 2")
def classes(spark, d):
    g = view(spark, d, "ais").groupBy(N.size_class("length").alias("size_class"), N.speed_class("sog").alias("speed_class")).agg(F.count(F.lit(1)).alias("n"))
    total = g.agg(F.sum("n").alias("t"))
    return g.join(F.broadcast(total)).select("size_class", "speed_class", "n", F.round(100.0 * F.col("n") / F.col("t"), 6).alias("pct"))


@query("p06_confidence_classes", D + "SELECT CASE WHEN confidence >= 0.8e0 THEN 'high' WHEN confidence >= 0.6e0 THEN 'medium' WHEN confidence >= 0.4e0 THEN 'low' ELSE 'very_low' END AS c, count(*) AS n FROM det GROUP BY 1")
def confidence(spark, d):
    return view(spark, d, "det").groupBy(N.confidence_class("confidence").alias("c")).agg(F.count(F.lit(1)).alias("n"))


_JOINED = f"(SELECT q.*, d.vessel_length_m AS len, {_SIZE.format('d.vessel_length_m')} AS size_class FROM ({FLAGSHIP_SQL}) q JOIN ({D} SELECT detect_id, vessel_length_m FROM det) d ON d.detect_id = q.detect_id) j"


def _joined(spark, d):
    return results(spark, d).join(view(spark, d, "det").select("detect_id", N.size_class("vessel_length_m").alias("size_class")), "detect_id")


@query("a13_grouped_means", f"SELECT size_class, round(avg(position_score), 5) AS position, round(avg(size_score), 5) AS size, round(avg(distance_meters), 3) AS distance FROM {_JOINED} WHERE matched_mmsi IS NOT NULL GROUP BY size_class")
def grouped(spark, d):
    return _joined(spark, d).filter("matched_mmsi IS NOT NULL").groupBy("size_class").agg(F.round(F.avg("position_score"), 5).alias("position"), F.round(F.avg("size_score"), 5).alias("size"), F.round(F.avg("distance_meters"), 3).alias("distance"))


@query("a14_success_by_class", f"SELECT size_class, count(*) AS total, count(matched_mmsi) AS correlated, round(100e0 * count(matched_mmsi) / count(*), 6) AS rate FROM {_JOINED} GROUP BY size_class")
def success(spark, d):
    return _joined(spark, d).groupBy("size_class").agg(F.count(F.lit(1)).alias("total"), F.count("matched_mmsi").alias("correlated"), F.round(100.0 * F.count("matched_mmsi") / F.count(F.lit(1)), 6).alias("rate"))


@query("a16_centroid_extent", A + f"SELECT {_SPEED.format('sog')} AS speed_class, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, min(lat) AS lat0, max(lat) AS lat1, min(lon) AS lon0, max(lon) AS lon1 FROM ais WHERE sog IS NOT NULL GROUP BY 1")
def centroid(spark, d):
    return view(spark, d, "ais").filter("sog IS NOT NULL").groupBy(N.speed_class("sog").alias("speed_class")).agg(F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon"), F.min("lat").alias("lat0"), F.max("lat").alias("lat1"), F.min("lon").alias("lon0"), F.max("lon").alias("lon1"))


@query("a18_w04_duplicate_groups", B + "SELECT detect_id, preprocess_row, preprocess_column, c AS copies FROM (SELECT *, count(*) OVER (PARTITION BY preprocess_row, preprocess_column) AS c FROM detbox) x WHERE c > 1")
def duplicates(spark, d):
    return N.duplicate_groups(view(spark, d, "detbox"), ["preprocess_row", "preprocess_column"]).select("detect_id", "preprocess_row", "preprocess_column", "copies")


@query("a19_density", B + "SELECT count(*) AS n, round(count(*) / (1200e0 * 1300e0 * 100e0 / 1e6), 6) AS per_km2 FROM detbox WHERE preprocess_column BETWEEN 200 AND 1400 AND preprocess_row BETWEEN 100 AND 1400")
def density(spark, d):
    a = view(spark, d, "detbox").filter(F.col("preprocess_column").between(200, 1400) & F.col("preprocess_row").between(100, 1400))
    return a.agg(F.count(F.lit(1)).alias("n"), F.round(F.count(F.lit(1)) / (1200.0 * 1300.0 * 100.0 / 1e6), 6).alias("per_km2"))


_THR = ", ".join(f"({i}, {i / 16}e0)" for i in range(1, 16))
_CM = BX + f", t AS (SELECT * FROM (VALUES {_THR}) AS v(i, thr)), c AS (SELECT thr, count(CASE WHEN is_gt = 1 AND score > thr THEN 1 END) AS tp, count(CASE WHEN is_gt = 0 AND score > thr THEN 1 END) AS fp, count(CASE WHEN is_gt = 1 AND score <= thr THEN 1 END) AS fn, count(CASE WHEN is_gt = 0 AND score <= thr THEN 1 END) AS tn FROM boxes, t GROUP BY thr)"
_F1 = "CASE WHEN tp = 0 THEN 0e0 ELSE CASE WHEN tp / CAST(tp + fp AS DOUBLE) + tp / CAST(tp + fn AS DOUBLE) < 0.01e0 THEN 0e0 ELSE 2e0 * (tp / CAST(tp + fp AS DOUBLE)) * (tp / CAST(tp + fn AS DOUBLE)) / (tp / CAST(tp + fp AS DOUBLE) + tp / CAST(tp + fn AS DOUBLE)) END END"


@query("a20_p24_threshold_sweep", _CM + f" SELECT thr, tp, fp, fn, tn, round({_F1}, 6) AS f1 FROM c")
def sweep(spark, d):
    s = N.threshold_sweep(view(spark, d, "boxes"), [i / 16 for i in range(1, 16)])
    return s.select("thr", "tp", "fp", "fn", "tn", F.round("f1", 6).alias("f1"))


@query("a23_best_threshold", _CM + f" SELECT thr, round({_F1}, 6) AS f1 FROM c ORDER BY {_F1} DESC, thr LIMIT 1")
def best(spark, d):
    return N.best_threshold(N.threshold_sweep(view(spark, d, "boxes"), [i / 16 for i in range(1, 16)])).select("thr", F.round("f1", 6).alias("f1"))


@query("a21_histograms", D + """, h AS (SELECT 'confidence' AS what, CASE WHEN confidence = 1 THEN 20 ELSE CAST(floor(confidence / 0.05e0) AS BIGINT) + 1 END AS bin FROM det WHERE confidence BETWEEN 0 AND 1
UNION ALL SELECT 'length', CASE WHEN vessel_length_m = 600 THEN 15 ELSE CAST(floor(vessel_length_m / 40e0) AS BIGINT) + 1 END FROM det WHERE vessel_length_m BETWEEN 0 AND 600) SELECT what, bin, count(*) AS n FROM h GROUP BY what, bin""")
def histograms(spark, d):
    t = view(spark, d, "det")
    return N.histogram(t, "confidence", 0.0, 1.0, 20).union(N.histogram(t, "vessel_length_m", 0.0, 600.0, 15, "length"))


@query("a22_a25_errors", BX + """, e AS (SELECT score AS p, x / 400e0 AS y, is_gt FROM boxes) SELECT round(avg(abs(p - y)), 6) AS mae, round(avg(power(p - y, 2)), 6) AS mse, round(-avg(power(p - y, 2)), 6) AS mse_score,
 round(avg(-ln(greatest(CASE WHEN is_gt = 1 THEN p ELSE 1e0 - p END, 1e-6))), 6) AS cross_entropy, round(avg(CASE WHEN (p > 0.5e0) = (is_gt = 1) THEN 1e0 ELSE 0e0 END), 6) AS accuracy FROM e""")
def errors(spark, d):
    return N.error_metrics(view(spark, d, "boxes").select(F.col("score").alias("p"), (F.col("x") / 400.0).alias("y"), "is_gt"))


@query("a26_mean_average_precision", BX + """, o AS (SELECT g.id AS gt, p.id, p.score, greatest(24e0 - abs(g.x - p.x), 0e0) * greatest(24e0 - abs(g.y - p.y), 0e0) AS i FROM boxes g JOIN boxes p ON g.scene_id = p.scene_id WHERE g.is_gt = 1 AND p.is_gt = 0),
b AS (SELECT DISTINCT id FROM (SELECT id, row_number() OVER (PARTITION BY gt ORDER BY score DESC, id) AS rn FROM o WHERE i / (1152e0 - i) >= 0.5e0) x WHERE rn = 1),
w AS (SELECT CASE WHEN b.id IS NULL THEN 0 ELSE 1 END AS hit, row_number() OVER (ORDER BY score DESC, p.id) AS n, sum(CASE WHEN b.id IS NULL THEN 0 ELSE 1 END) OVER (ORDER BY score DESC, p.id) AS tp FROM boxes p LEFT JOIN b ON b.id = p.id WHERE is_gt = 0)
SELECT round(coalesce(sum(tp / CAST(n AS DOUBLE)), 0e0) / (SELECT count(*) FROM boxes WHERE is_gt = 1), 6) AS average_precision FROM w WHERE hit = 1""")
def mean_ap(spark, d):
    return N.average_precision(view(spark, d, "boxes"), 0.5, 24.0)


@query("a27_p25_percent_error", BX + """, e AS (SELECT abs(x - y) AS d, least(x, y) AS lo, greatest(x, y) AS hi, x, y FROM boxes WHERE x > 0 AND y > 0) SELECT round(1e0 - avg(least(d / hi, 1e0)), 6) AS size_score, round(avg(d / x), 6) AS normalised, round(1e0 - avg(least(least(d, 360e0 - d), 180e0)) / 180e0, 6) AS degree_score FROM e""")
def percent(spark, d):
    return N.percent_errors(view(spark, d, "boxes").filter("x > 0 AND y > 0"), "x", "y")


@query("a29_weighted_mean", D + "SELECT scene_id, round(sum(lat * confidence) / sum(confidence), 6) AS lat, round(sum(lon * confidence) / sum(confidence), 6) AS lon FROM det GROUP BY scene_id")
def weighted(spark, d):
    return view(spark, d, "det").groupBy("scene_id").agg(*[F.round(F.sum(F.col(c) * F.col("confidence")) / F.sum("confidence"), 6).alias(c) for c in ("lat", "lon")])


@query("a30_a31_mask_statistics", cte("duck", "cells") + "SELECT quantile_cont(CASE WHEN vv > 0 THEN vv END, 0.01) AS p1, quantile_cont(CASE WHEN vv > 0 THEN vv END, 0.25) AS p25, quantile_cont(CASE WHEN vv > 0 THEN vv END, 0.99) AS p99, round(100e0 * avg(CASE WHEN vv = 0 THEN 1e0 ELSE 0e0 END), 6) AS zero_pct, round(100e0 * avg(CAST(water AS DOUBLE)), 6) AS water_pct FROM cells")
def mask_stats(spark, d):
    return N.mask_statistics(view(spark, d, "cells"))


@query("a32_sampling_weights", BX + ", c AS (SELECT sum(is_gt) AS fg, count(*) - sum(is_gt) AS bg FROM boxes) SELECT id, CASE WHEN is_gt = 1 THEN 1e0 ELSE round(0.25e0 * fg / bg, 9) END AS weight FROM boxes, c")
def weights(spark, d):
    return N.sampling_weights(view(spark, d, "boxes"), "is_gt", 0.25).select("id", "weight")


@query("a35_coverage_report", f"""WITH t AS ({TR} SELECT * FROM truth), q AS (SELECT DISTINCT matched_mmsi AS m FROM ({FLAGSHIP_SQL}) z WHERE matched_mmsi IS NOT NULL)
SELECT q.m IS NOT NULL AS found, count(*) AS vessels, round(avg(sog), 4) AS sog, round(avg(length), 4) AS length, round(avg(width), 4) AS width FROM t LEFT JOIN q ON q.m = t.mmsi GROUP BY 1""")
def coverage(spark, d):
    q = results(spark, d).filter("matched_mmsi IS NOT NULL").select(F.col("matched_mmsi").alias("mmsi"), F.lit(True).alias("f")).distinct()
    t = view(spark, d, "truth").join(q, "mmsi", "left").withColumn("found", F.coalesce("f", F.lit(False)))
    return t.groupBy("found").agg(F.count(F.lit(1)).alias("vessels"), *[F.round(F.avg(c), 4).alias(c) for c in ("sog", "length", "width")])


@query("w02_best_candidate", f"SELECT detect_id, distance_meters AS m FROM ({FLAGSHIP_SQL}) q WHERE distance_meters IS NOT NULL")
def candidate(spark, d):
    p = K.predict(K.clean_reports(view(spark, d, "ais"), T_US, 72))
    return K.choose(K.scored(K.candidates(view(spark, d, "det"), p))).select("detect_id", F.round("distance_m", 4).alias("m"))


@query("w03_sequential_ids", D + "SELECT detect_id, scene_id, 'scene' || scene_id || '_vessel_' || lpad(CAST(row_number() OVER (PARTITION BY scene_id ORDER BY confidence DESC, detect_id) - 1 AS VARCHAR), 4, '0') AS vessel FROM det")
def ids(spark, d):
    n = F.row_number().over(Window.partitionBy("scene_id").orderBy(F.desc("confidence"), "detect_id")) - 1
    # %04d pads and never cuts, as in the reference: the SQL's lpad gives 1234 for 12345. No scene, no name.
    return view(spark, d, "det").select("detect_id", "scene_id", F.concat(F.lit("scene"), F.col("scene_id").cast("string"), F.lit("_vessel_"), F.format_string("%04d", n)).alias("vessel"))


@query("w06_min_max_normalise", B + "SELECT detect_id, round((confidence - min(confidence) OVER ()) / (max(confidence) OVER () - min(confidence) OVER () + 1e-8), 6) AS norm FROM detbox")
def normalise(spark, d):
    return N.min_max(view(spark, d, "detbox"), "confidence").select("detect_id", F.round("confidence_norm", 6).alias("norm"))


@query("w08_gap_samples", A + f", g AS (SELECT DISTINCT CAST(floor((({T_US}) - us) / 60e6) AS BIGINT) AS m FROM ais WHERE us <= {T_US}), r AS (SELECT m, row_number() OVER (ORDER BY m) - 1 AS k, count(*) OVER () AS n FROM g) SELECT m FROM r WHERE n <= 50 OR k % (n // 50) = 0")
def samples(spark, d):
    g = view(spark, d, "ais").filter(F.col("us") <= T_US).select(F.floor((F.lit(T_US) - F.col("us")) / 60e6).alias("m")).distinct()
    return N.every_kth(g, "m", 50)


@query("w09_gradual_batches", cte("duck", "windows") + """, w AS (SELECT id, row_px, col_px, lag(row_px) OVER o AS r0, lag(col_px) OVER o AS c0 FROM windows WHERE dataset_id = 3 WINDOW o AS (ORDER BY row_px, col_px, id))
SELECT id, CAST(sum(CASE WHEN sqrt(power(row_px - r0, 2) + power(col_px - c0, 2)) > 24 THEN 1 ELSE 0 END) OVER (ORDER BY row_px, col_px, id) AS BIGINT) AS batch FROM w""")
def batches(spark, d):
    return N.distance_batches(view(spark, d, "windows").filter("dataset_id = 3"), "dataset_id", 24.0).select("id", "batch")


@query("t01_t03_top_confidence", D + "SELECT detect_id, round(confidence, 6) AS confidence FROM det ORDER BY confidence DESC, detect_id LIMIT 25")
def top(spark, d):
    return view(spark, d, "det").orderBy(F.desc("confidence"), "detect_id").limit(25).select("detect_id", F.round("confidence", 6).alias("confidence"))


@query("t02_nearest_to_centre", B + "SELECT detect_id, round(sqrt(power(preprocess_column - 750, 2) + power(preprocess_row - 750, 2)), 4) AS px FROM detbox ORDER BY sqrt(power(preprocess_column - 750, 2) + power(preprocess_row - 750, 2)), detect_id LIMIT 5")
def centre(spark, d):
    p = F.sqrt(F.pow(F.col("preprocess_column") - 750, 2) + F.pow(F.col("preprocess_row") - 750, 2))
    return view(spark, d, "detbox").withColumn("p", p).orderBy("p", "detect_id").limit(5).select("detect_id", F.round("p", 4).alias("px"))


@query("t05_t06_sorted_lists", cte("duck", "labels") + "SELECT window_id, list_sort(list(DISTINCT value)) AS vals, count(*) AS n FROM labels GROUP BY window_id HAVING count(*) > 6")
def lists(spark, d):
    return view(spark, d, "labels").groupBy("window_id").agg(F.array_sort(F.collect_set("value")).alias("vals"), F.count(F.lit(1)).alias("n")).filter("n > 6")
