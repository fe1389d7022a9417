"""Filters (F), quality statistics (A03, P01) and report rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagos.operators import filters as L
from pelagos.operators.spatial import avoid_filter
from pelagos.plans.adapters import T_US, cte, view
from pelagos.plans.catalog import query

D = cte("duck", "det")
B = cte("duck", "detbox")
_N = """(CASE WHEN vessel_length_m > 0 THEN 1 ELSE 0 END + CASE WHEN vessel_width_m > 0 THEN 1 ELSE 0 END + CASE WHEN vessel_speed_k >= 0 THEN 1 ELSE 0 END
 + CASE WHEN vessel_type IN ('fishing', 'cargo', 'other') THEN 1 ELSE 0 END + CASE WHEN heading_degrees BETWEEN 0 AND 360 THEN 1 ELSE 0 END + CASE WHEN is_fishing_vessel IS NOT NULL THEN 1 ELSE 0 END)"""
_W = f"us BETWEEN {T_US} - {{0}} AND {T_US} + {{0}}"


@query("f01_f05_quality_filter", D + f"SELECT detect_id, {_N} AS attribute_count FROM det WHERE confidence >= 0.3e0 AND {_N} >= 3 AND vessel_length_m BETWEEN 5 AND 500 AND vessel_speed_k <= 50 AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180")
def quality(spark, d):
    return L.quality_filter(view(spark, d, "det")).select("detect_id", "attribute_count")


@query("p01_attribute_count", D + f"SELECT detect_id, {_N} AS attribute_count FROM det")
def attributes(spark, d):
    return view(spark, d, "det").select("detect_id", L.attribute_count().alias("attribute_count"))


@query("a03_filter_statistics", D + f""", s AS (SELECT confidence >= 0.3e0 AS a, {_N} >= 3 AS b, coalesce(vessel_length_m BETWEEN 5 AND 500, false) AS c, coalesce(vessel_speed_k <= 50, false) AS e, coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, false) AS f FROM det)
SELECT count(*) AS total, count(CASE WHEN a THEN 1 END) AS after_confidence, count(CASE WHEN a AND b THEN 1 END) AS after_attributes, count(CASE WHEN a AND b AND c THEN 1 END) AS after_size, count(CASE WHEN a AND b AND c AND e THEN 1 END) AS after_speed,
 count(CASE WHEN a AND b AND c AND e AND f THEN 1 END) AS after_coordinates, round(count(CASE WHEN a AND b AND c AND e AND f THEN 1 END) / CAST(count(*) AS DOUBLE), 6) AS retention FROM s""")
def filter_stats(spark, d):
    return L.filter_statistics(view(spark, d, "det"))


@query("f06_null_drop", cte("duck", "ais") + "SELECT count(*) AS rows_left FROM ais WHERE sog IS NOT NULL AND cog IS NOT NULL")
def nulls(spark, d):
    return view(spark, d, "ais").na.drop(subset=["sog", "cog"]).agg(F.count(F.lit(1)).alias("rows_left"))


for _h, _f in ((2, 6), (0.001, 6)):
    _a, _b = _W.format(int(_h * 3600e6)), _W.format(int(_f * 3600e6))

    @query(f"f07_window_fallback_{str(_h).replace('.', '_')}h", cte("duck", "ais") + f"SELECT seq, mmsi, us FROM ais WHERE {_a} OR ({_b} AND NOT EXISTS (SELECT 1 FROM ais WHERE {_a}))")
    def fallback(spark, d, h=_h, f=_f):
        return L.time_window(view(spark, d, "ais"), T_US, h, f).select("seq", "mmsi", "us")


@query("f08_time_windows", cte("duck", "ais") + f"SELECT count(CASE WHEN {_W.format(600000000)} THEN 1 END) AS m10, count(CASE WHEN {_W.format(300000000)} THEN 1 END) AS m5, count(CASE WHEN {_W.format(60000000)} THEN 1 END) AS m1, count(CASE WHEN {_W.format(86400000000)} THEN 1 END) AS d1 FROM ais")
def windows(spark, d):
    return view(spark, d, "ais").agg(*[F.count_if(F.col("us").between(T_US - m * 60_000_000, T_US + m * 60_000_000)).alias(n) for n, m in (("m10", 10), ("m5", 5), ("m1", 1), ("d1", 1440))])


@query("f09_bounding_box", cte("duck", "ais") + "SELECT seq, mmsi FROM ais WHERE lat BETWEEN 36.2e0 AND 37.4e0 AND lon BETWEEN -76.8e0 AND -75.3e0")
def box(spark, d):
    return L.bounding_box(view(spark, d, "ais"), 36.2, 37.4, -76.8, -75.3).select("seq", "mmsi")


@query("f10_bounds_from_data", D + ", b AS (SELECT min(lat) - 0.01e0 AS a, max(lat) + 0.01e0 AS b, min(lon) - 0.01e0 AS c, max(lon) + 0.01e0 AS e FROM det), " + cte("duck", "ais").removeprefix("WITH ").replace("ais AS", "ais2 AS", 1) + "SELECT seq FROM ais2, b WHERE lat BETWEEN b.a AND b.b AND lon BETWEEN b.c AND b.e")
def data_bounds(spark, d):
    return L.within_bounds_of(view(spark, d, "ais"), view(spark, d, "det")).select("seq")


@query("f11_f12_f16_regions", B + """SELECT detect_id, (bbox_x1 + bbox_x2) / 2e0 BETWEEN 200 AND 900 AND (bbox_y1 + bbox_y2) / 2e0 BETWEEN 100 AND 800 AS in_region, preprocess_column BETWEEN 202 AND 1200 AND preprocess_row BETWEEN 126 AND 1390 AS in_area,
 preprocess_row >= 0 AND preprocess_row < 1400 AND preprocess_column >= 0 AND preprocess_column < 1450 AS in_image FROM detbox""")
def regions(spark, d):
    x, y = (F.col("bbox_x1") + F.col("bbox_x2")) / 2, (F.col("bbox_y1") + F.col("bbox_y2")) / 2
    return view(spark, d, "detbox").select("detect_id", (x.between(200, 900) & y.between(100, 800)).alias("in_region"), (F.col("preprocess_column").between(202, 1200) & F.col("preprocess_row").between(126, 1390)).alias("in_area"), L.in_image("preprocess_row", "preprocess_column", 1400, 1450).alias("in_image"))


@query("f13_keep_bounds", B + """, w AS (SELECT detect_id, preprocess_column % 512 AS x, preprocess_row % 512 AS y, CAST(floor(preprocess_column / 512e0) AS BIGINT) * 512 AS c0, CAST(floor(preprocess_row / 512e0) AS BIGINT) * 512 AS r0 FROM detbox)
SELECT detect_id, x, y FROM w WHERE x BETWEEN (CASE WHEN c0 = 0 THEN 0 ELSE 40 - 16 END) AND (CASE WHEN c0 >= 1500 - 512 THEN 512 ELSE 512 - 40 + 16 END) AND y BETWEEN (CASE WHEN r0 = 0 THEN 0 ELSE 40 - 16 END) AND (CASE WHEN r0 >= 1500 - 512 THEN 512 ELSE 512 - 40 + 16 END)""")
def keep(spark, d):
    w = view(spark, d, "detbox").select("detect_id", (F.col("preprocess_column") % 512).alias("x"), (F.col("preprocess_row") % 512).alias("y"), (F.floor(F.col("preprocess_column") / 512) * 512).alias("c0"), (F.floor(F.col("preprocess_row") / 512) * 512).alias("r0"))
    return w.filter(L.keep_bounds("x", "y", "c0", "r0", 512, 40, 16, 1500, 1500)).select("detect_id", "x", "y")


@query("f14_overlap_strip", B + "SELECT detect_id FROM detbox WHERE NOT (preprocess_column % 512 < 32 OR preprocess_column % 512 > 480 OR preprocess_row % 512 < 32 OR preprocess_row % 512 > 480)")
def strip(spark, d):
    return view(spark, d, "detbox").filter(~L.in_overlap(F.col("preprocess_column") % 512, F.col("preprocess_row") % 512, 512, 32)).select("detect_id")


@query("f18_training_windows", cte("duck", "windows", "labels") + "SELECT w.id, w.split FROM windows w WHERE w.dataset_id IN (1, 2, 3) AND w.split IN ('train', 'val') AND EXISTS (SELECT 1 FROM labels l WHERE l.window_id = w.id AND l.value IN ('A', 'R'))")
def training(spark, d):
    lab = view(spark, d, "labels").filter(F.col("value").isin("A", "R")).select(F.col("window_id").alias("id"))
    return view(spark, d, "windows").filter(F.col("dataset_id").isin(1, 2, 3) & F.col("split").isin("train", "val")).join(lab, "id", "left_semi").select("id", "split")


@query("f19_split_filter", cte("duck", "windows") + "SELECT split, count(*) AS n FROM windows WHERE split IN ('val', 'test') GROUP BY split")
def splits(spark, d):
    return view(spark, d, "windows").filter(F.col("split").isin("val", "test")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("f20_helper_labels", "SELECT event_id FROM events WHERE props NOT LIKE '%\"k\": 1%'")
def helper(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.filter(~F.col("props").contains('"k": 1')).select("event_id")


@query("f21_strict_containment", B + "SELECT detect_id FROM detbox WHERE (bbox_x1 + bbox_x2) / 2e0 > 100 AND (bbox_x1 + bbox_x2) / 2e0 < 700 AND (bbox_y1 + bbox_y2) / 2e0 > 100 AND (bbox_y1 + bbox_y2) / 2e0 < 700")
def containment(spark, d):
    x, y = (F.col("bbox_x1") + F.col("bbox_x2")) / 2, (F.col("bbox_y1") + F.col("bbox_y2")) / 2
    return view(spark, d, "detbox").filter((x > 100) & (x < 700) & (y > 100) & (y < 700)).select("detect_id")


@query("f25_score_gate", cte("duck", "boxes") + "SELECT id FROM boxes WHERE score >= CASE id % 2 WHEN 0 THEN 0.4e0 ELSE 0.7e0 END")
def gate(spark, d):
    return view(spark, d, "boxes").filter(F.col("score") >= F.when(F.col("id") % 2 == 0, 0.4).otherwise(0.7)).select("id")


@query("f26_validation_report", D + """SELECT 'error' AS level, 'lat_range' AS rule, count(CASE WHEN lat NOT BETWEEN -90 AND 90 OR lat IS NULL THEN 1 END) AS violations FROM det
UNION ALL SELECT 'error', 'lon_range', count(CASE WHEN lon NOT BETWEEN -180 AND 180 OR lon IS NULL THEN 1 END) FROM det
UNION ALL SELECT 'error', 'confidence_range', count(CASE WHEN confidence NOT BETWEEN 0 AND 1 OR confidence IS NULL THEN 1 END) FROM det
UNION ALL SELECT 'warning', 'length_positive', count(CASE WHEN vessel_length_m <= 0 THEN 1 END) FROM det
UNION ALL SELECT 'warning', 'speed_range', count(CASE WHEN vessel_speed_k NOT BETWEEN 0 AND 60 THEN 1 END) FROM det
UNION ALL SELECT 'warning', 'heading_range', count(CASE WHEN heading_degrees NOT BETWEEN 0 AND 360 THEN 1 END) FROM det""")
def report(spark, d):
    return L.validation_report(view(spark, d, "det"))


for _mode in ("compat", "strict"):
    _cos = "cos(alat)" if _mode == "compat" else "cos(radians(alat))"

    @query(f"j07_avoid_locations_{_mode}", D + ", " + cte("duck", "avoid").removeprefix("WITH ") + f"SELECT detect_id FROM det WHERE NOT EXISTS (SELECT 1 FROM avoid WHERE lat BETWEEN alat - coalesce(width_m, 100e0) / 2e0 / 111000e0 AND alat + coalesce(width_m, 100e0) / 2e0 / 111000e0 AND lon BETWEEN alon - coalesce(width_m, 100e0) / 2e0 / (111000e0 * {_cos}) AND alon + coalesce(width_m, 100e0) / 2e0 / (111000e0 * {_cos}))")
    def avoid(spark, d, strict=_mode == "strict"):
        return avoid_filter(view(spark, d, "det"), view(spark, d, "avoid"), strict).select("detect_id")
