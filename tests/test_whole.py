"""The queries that take every row, against brute force on small tables."""

import math

import pytest

from pelagos.plans import catalog


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("whole"))
    spark.sql("SELECT id AS event_id, id % 50 AS user_id, timestamp_micros(1705320000000000 - (id % 97) * 60000000) AS ts, cast(id % 500 AS DOUBLE) AS value FROM range(5000)").write.parquet(folder + "/events.parquet")
    out = lambda name: catalog.queries()[name](spark, folder).collect()
    out.folder = folder
    return out


def _box(i):
    g, off = (i, 0) if i % 2 else (i + 1, 1)
    return i, i // 250, i % 2, g * 37 % 400 + off * (i % 23 - 11), g * 91 % 400 + off * (i % 19 - 9), i * 13 % 100 / 100


BOXES = [_box(i) for i in range(5000)]


def test_matching_counts_every_box(run):
    assert sum(r.tp + r.fn for r in run("j23_a24_point_matching")) == sum(r.tp + r.fp for r in run("j23_a24_point_matching")) == 2500
    r = run("a24_scene_metrics")[0]
    assert (r.tp + r.fn, r.tp + r.fp) == (2500, 2500)
    assert sum(r.tp + r.fn for r in run("j24_box_matching")) == 2500


def test_average_precision_of_every_box(run):
    hits, over = set(), lambda a, b: (w := 24 - abs(a[3] - b[3])) > 0 and (h := 24 - abs(a[4] - b[4])) > 0 and w * h / (1152 - w * h) >= 0.5
    for g in (b for b in BOXES if b[2]):
        near = [p for p in BOXES[g[1] * 250:g[1] * 250 + 250] if not p[2] and over(g, p)]
        if near:
            hits.add(min(near, key=lambda p: (-p[5], p[0]))[0])
    tp, s = 0, 0.0
    for n, p in enumerate(sorted((b for b in BOXES if not b[2]), key=lambda p: (-p[5], p[0])), 1):
        if p[0] in hits:
            tp += 1
            s += tp / n
    assert abs(run("a26_mean_average_precision")[0].average_precision - s / 2500) < 1e-6


def test_suppression_of_every_box(run):
    kept = []
    for b in sorted((b for b in BOXES if not b[2]), key=lambda b: (-b[5], b[0])):
        if all(k[1] != b[1] or math.dist(k[3:5], b[3:5]) > 15 for k in kept):
            kept.append(b)
    assert {r.id for r in run("j18_distance_nms")} == {b[0] for b in kept} and len(kept) < 2500


def test_metrics_of_every_box(run):
    for r in run("a20_p24_threshold_sweep"):
        over = [b for b in BOXES if b[5] > r.thr]
        assert (r.tp, r.fp) == (sum(b[2] for b in over), sum(1 - b[2] for b in over)) and r.tp + r.fp + r.fn + r.tn == 5000
    best = max(run("a20_p24_threshold_sweep"), key=lambda r: (r.f1, -r.thr))
    assert run("a23_best_threshold")[0] == (best.thr, best.f1)
    assert abs(run("a22_a25_errors")[0].mae - sum(abs(b[5] - b[3] / 400) for b in BOXES) / 5000) < 1e-6
    some = [b for b in BOXES if b[3] > 0 and b[4] > 0]
    assert abs(run("a27_p25_percent_error")[0].normalised - sum(abs(b[3] - b[4]) / b[3] for b in some) / len(some)) < 1e-6
    assert len(run("a32_sampling_weights")) == len(run("p08_softmax")) == 5000
    assert {r.id for r in run("f25_score_gate")} == {b[0] for b in BOXES if b[5] >= (0.7 if b[2] else 0.4)}


CELLS = {(i % 64, i // 64): (int(i * 7919 % 100 < 62), i * 31 % 251, i * 17 % 241) for i in range(5000)}


def test_regions_of_every_cell(run):
    wet, want = {c for c, v in CELLS.items() if v[0]}, set()
    while wet:
        found, ahead = set(), [wet.pop()]
        while ahead:
            x, y = ahead.pop()
            found.add((x, y))
            near = {(x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1)} & wet
            wet -= near
            ahead += near
        xs, ys = [c[0] for c in found], [c[1] for c in found]
        want.add((min(y * 64 + x for x, y in found), len(found), min(xs), max(xs), min(ys), max(ys)))
    assert {tuple(r) for r in run("r02_water_regions")} == want


def test_rasters_of_every_cell(run):
    assert len(run("r01_water_mask")) == len(run("r03_r04_r14_channels")) == 5000
    at = lambda x, y: CELLS.get((x, y), (0, 0, 0))[1]
    got = {(r.cx, r.cy): r.value for r in run("r04_sobel_kernel")}
    assert got == {(x, y): sum(w * (at(x + 1, y + j) - at(x - 1, y + j)) for j, w in ((-1, 1), (0, 2), (1, 1))) for x, y in CELLS}
    assert abs(run("a30_a31_mask_statistics")[0].water_pct - sum(v[0] for v in CELLS.values()) / 50) < 1e-6
    windows = {(r, c): [CELLS.get((x, y), (0, 0, 0)) for x in range(c, c + 16) for y in range(r, r + 16)] for r in range(0, 64, 12) for c in range(0, 49, 12) if r <= 79 - 16}
    share = {k: sum(v[0] for v in w) / 256 for k, w in windows.items()}
    assert {(r.row, r.col): r.water_share for r in run("f17_window_coverage")} == {k: round(v, 6) for k, v in share.items() if v >= 0.6}
    blocks = [[at(x, y) for x in range(c, c + 8) for y in range(r, r + 8)] for r in range(0, 79 - 7, 8) for c in range(0, 64, 8)]
    r = run("a34_window_statistics")[0]
    assert (r.total, r.skipped) == (len(blocks), sum(all(v <= 240 for v in b) for b in blocks))


def test_offset_of_every_cell(run):
    mean = {}
    for dy in (-2, 1):
        for dx in (-2, 1):
            pairs = [v[1] * CELLS[(x - dx - 2, y - dy + 1)][1] for (x, y), v in CELLS.items() if (x - dx - 2, y - dy + 1) in CELLS]
            mean[dy, dx] = sum(pairs) / len(pairs)
    r = run("r06_alignment_offset")[0]
    best = min(mean, key=lambda k: (-mean[k], k))
    assert (r.dy, r.dx) == best and abs(r.mean - mean[best]) < 1e-6


@pytest.fixture(scope="module")
def seen(spark, tmp_path_factory, run):
    """det and pred72 of the small table, as rows."""
    from pelagos.plans.adapters import view
    return lambda name: view(spark, run.folder, name).collect()


def test_distances_of_all_pairs(run, seen):
    p = [(r.lat, r.lon) for r in seen("det")]
    m = sorted(111000 * math.dist(a, b) for i, a in enumerate(p) for b in p[:i])
    r = run("j12_a17_pair_distances")[0]
    middle = (m[(len(m) - 1) // 2] + m[len(m) // 2]) / 2
    assert (r.pairs, r.under_100, r.under_500) == (len(m), sum(v < 100 for v in m), sum(v < 500 for v in m)) and r.max_m > 500_000
    assert max(abs(r.min_m - m[0]), abs(r.max_m - m[-1]), abs(r.avg_m - sum(m) / len(m)), abs(r.median_m - middle)) < 2e-3


def test_quantiles_by_selection(spark):
    import numpy as np

    from pelagos.operators import spatial
    for n in (1, 2, 999, 1000):
        values = [i * 7919 % 1009 % 300 / 7 for i in range(n)]
        df = spark.createDataFrame([(v,) for v in values + [None]], "m double")
        probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
        assert np.allclose(spatial.quantiles(df, "m", probs, 4, 10), np.quantile(values, probs), atol=1e-12)
    assert spatial.quantiles(df.limit(0), "m", [0.5]) == [None]


def test_nearest_of_several_blocks(spark):
    from pyspark.sql import functions as F

    from pelagos.operators import spatial
    p, to = spark.range(50).selectExpr("id AS k", "id * 1.5D AS a"), spark.range(100).selectExpr("id * 2.3D AS b")
    got = {r.k: r.min_distance for r in spatial.nearest_point(p, to, F.abs(F.col("a") - F.col("b")), "k", block=7).collect()}
    assert got == {k: min(abs(k * 1.5 - i * 2.3) for i in range(100)) for k in range(50)}


def _most(pairs):
    """Size of a largest matching, by augmenting paths."""
    near, owner = {}, {}
    for a, b in pairs:
        near.setdefault(a, []).append(b)

    def put(a, seen):
        for b in near[a]:
            if b not in seen:
                seen.add(b)
                if b not in owner or put(owner[b], seen):
                    owner[b] = a
                    return True
        return False
    return sum(put(a, set()) for a in near)


def test_matchings_are_the_largest(run):
    for name, near in (("j23_a24_point_matching", lambda a, b: math.dist(a[3:5], b[3:5]) < 20), ("j24_box_matching", lambda a, b: abs(a[3] - b[3]) <= 24 and abs(a[4] - b[4]) <= 24)):
        got = {r.scene_id: r.tp for r in run(name)}
        for s in range(20):
            part = BOXES[s * 250:s * 250 + 250]
            assert got[s] == _most([(a[0], b[0]) for a in part if a[2] for b in part if not b[2] and near(a, b)]) > 0


def _metres(lat1, lon1, lat2, lon2):
    lat1, lon1, lat2, lon2 = map(math.radians, (lat1, lon1, lat2, lon2))
    a = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371000 * math.asin(math.sqrt(min(a, 1)))


def test_nearest_of_all_reports(spark, tmp_path):
    # one vessel with a report, and dark detections some 5 degrees north of all reports
    spark.sql("SELECT id * 53 AS event_id, 1L AS user_id, timestamp_micros(1705320000000000 - id * 60000000) AS ts, 100e0 AS value FROM range(20)").write.parquet(str(tmp_path / "events.parquet"))
    from pelagos.plans.adapters import view
    det = sorted(view(spark, str(tmp_path), "det").collect(), key=lambda r: r.detect_id)[:10]
    pred = view(spark, str(tmp_path), "pred72").collect()
    got = {r.detect_id: r.nearest_m for r in catalog.queries()["j14_nearest_report"](spark, str(tmp_path)).collect()}
    want = {r.detect_id: min(_metres(r.lat, r.lon, p.plat, p.plon) for p in pred) for r in det}
    assert got.keys() == want.keys() and len(got) == 10 and all(abs(got[k] - want[k]) < 0.01 for k in want)
    assert max(got.values()) > 100_000


def test_candidates_at_every_latitude(spark):
    from pelagos.operators import correlate
    d = [(1, 80.0, 10.0), (2, 20.0, 179.9995), (3, 89.999, 0.0), (4, 36.0, -76.0), (5, -80.0, 30.04), (6, 0.0, 0.0), (7, None, 1.0)]
    p = [(1, 80.0, 10.041), (2, 20.0, -179.9995), (3, 89.999, 180.0), (4, 36.004, -76.004), (5, -80.0, 30.0), (6, -0.003, -0.003), (7, 36.008, -76.0), (8, None, 1.0)]
    det = spark.createDataFrame(d, "detect_id long, lat double, lon double").selectExpr("*", "0.9D AS confidence", "1D AS vessel_length_m", "1D AS vessel_width_m", "1D AS vessel_speed_k", "'cargo' AS vessel_type", "0D AS heading_degrees")
    pred = spark.createDataFrame(p, "mmsi long, plat double, plon double").selectExpr("*", "1D AS sog", "0D AS heading", "70 AS vtype", "1D AS len_f", "1D AS wid_f", "60D AS minutes", "0D AS uncertainty_m")
    got = sorted((r.detect_id, r.mmsi) for r in correlate.candidates(det, pred).collect())
    assert got == [(i, j) for i, *a in d for j, *b in p if None not in a + b and _metres(*a, *b) <= 800] and len(got) == 6


def _hungarian(cost):
    """Least cost of a full assignment (rows <= columns) on a dense matrix."""
    import numpy as np
    n, m = cost.shape
    u, v, owner, way = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j0, least, used = i, 0, np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while owner[j0]:
            used[j0] = True
            now = cost[owner[j0] - 1] - u[owner[j0]] - v[1:]
            better = ~used[1:] & (now < least[1:])
            least[1:][better], way[1:][better] = now[better], j0
            j1 = int(np.argmin(np.where(~used[1:], least[1:], np.inf))) + 1
            step = least[j1]
            u[owner[used]] += step
            v[used] -= step
            least[1:][~used[1:]] -= step
            j0 = j1
        while j0:
            owner[j0] = owner[way[j0]]
            j0 = way[j0]
    return sum(cost[owner[j] - 1, j - 1] for j in range(1, m + 1) if owner[j])


def test_assignment_of_every_detection(spark, run):
    import numpy as np

    from pelagos.operators import correlate as K
    from pelagos.plans.adapters import T_US, view
    pred = K.predict(K.clean_reports(view(spark, run.folder, "ais"), T_US, 72))
    pairs = {(r.detect_id, r.mmsi): r.total for r in K.choose_all(K.scored(K.candidates(view(spark, run.folder, "det"), pred))).collect() if r.total >= 0.5}
    d, m = sorted({i for i, _ in pairs}), sorted({j for _, j in pairs})
    gain = np.zeros((len(d), len(m) + len(d)))
    for (i, j), t in pairs.items():
        gain[d.index(i), m.index(j)] = t - 0.5 + 1e-6
    got = run("j22_optimal_assignment")
    assert len({r.detect_id for r in got}) == len({r.mmsi for r in got}) == len(got) > 0
    assert abs(sum(pairs[r.detect_id, r.mmsi] - 0.5 + 1e-6 for r in got) + _hungarian(-gain)) < 1e-6


def test_quality_merge_of_every_detection(run, seen):
    rows = []
    for r in seen("det"):
        kind = 1 if r.vessel_length_m is not None and r.vessel_length_m < 60 else 3 if r.vessel_length_m is not None and r.vessel_length_m > 150 else 2
        q = min(r.confidence + (4 - kind) * 0.1 + 0.1 * ((r.vessel_length_m or 0) > 0) + 0.1 * ((r.vessel_width_m or 0) > 0), 1.0)
        rows.append((q, r))
    want = _merged([(q, r.detect_id, r.lon, r.lat, r.confidence, r.vessel_length_m, r.vessel_width_m, r.vessel_speed_k) for q, r in rows], 0.002)
    got = {r.id: (r.lon, r.lat, r.score, r.vessel_length_m, r.vessel_width_m, r.vessel_speed_k, r.members) for r in run("j20_j25_quality_merge")}
    assert got.keys() == want.keys()
    assert all(a == b or abs(a - b) < 2e-6 for k in want for a, b in zip(got[k], want[k]))


def _merged(rows, radius):
    """rows (quality, id, lon, lat, score, three sizes): greedy, the primary counts twice."""
    want, left = {}, sorted(rows, key=lambda x: (-x[0], x[1]))
    while left:
        p, *others = left
        near = [x for x in others if math.dist(x[2:4], p[2:4]) < radius]
        part = [p, p, *near]
        sizes = [[x[c] for x in part if x[c] is not None and x[c] > 0] for c in (5, 6, 7)]
        want[p[1]] = (*[sum(x[0] * x[c] for x in part) / sum(x[0] for x in part) for c in (2, 3)], max(x[4] for x in part), *[sum(v) / len(v) if v else None for v in sizes], len(part))
        left = [x for x in others if x not in near]
    return want


def test_quality_merge_of_crowded_rows(spark):
    import random

    from pelagos.operators import dedupe
    rng = random.Random(3)
    rows = [(rng.randrange(1, 9) / 8, i, rng.random() / 50, rng.random() / 50, rng.random(), rng.choice([None, 0.0, 5.5, 90.0]), rng.choice([None, 3.0]), 1.0) for i in range(250)]
    df = spark.createDataFrame(rows, "quality double, id long, lon double, lat double, score double, vessel_length_m double, vessel_width_m double, vessel_speed_k double")
    want = _merged(rows, 0.003)
    got = {r.id: (r.lon, r.lat, r.score, r.vessel_length_m, r.vessel_width_m, r.vessel_speed_k, r.members) for r in dedupe.weighted_merge(df, 0.003).collect()}
    assert got.keys() == want.keys() and max(w[-1] for w in want.values()) > 5
    assert all(a == b or abs(a - b) < 1e-9 for k in want for a, b in zip(got[k], want[k]))


def test_multi_scale_merge_of_every_detection(run, seen):
    rows = [(r.detect_id, r.preprocess_row, r.preprocess_column, r.confidence, 30 if r.detect_id % 3 == 0 else 50, r.vessel_length_m or 0, r.vessel_width_m or 0, 512 if r.detect_id % 2 == 0 else 1024) for r in seen("detbox")]
    want, out = {}, set()
    for h in sorted(rows, key=lambda r: (-r[3], r[0])):
        if h[0] in out:
            continue
        part = [r for r in rows if abs(r[1] - h[1]) <= h[4] and abs(r[2] - h[2]) <= h[4]]
        out |= {r[0] for r in part if (-r[3], r[0]) > (-h[3], h[0])}
        best = max(part, key=lambda r: (round(r[3] + 0.1 * (r[5] > 0) + 0.1 * (r[6] > 0) + (1024 - r[7]) / 1024 * 0.1, 12), r[3], -r[0]))
        want[h[0]] = (best[0], best[3])
    got = {r.head: (r.best, r.score) for r in run("j21_multi_scale_merge")}
    assert got == want and len(want) < len(rows)


def test_average_precision_needs_hits(run):
    assert 0 < run("a26_mean_average_precision")[0].average_precision < 1


def _names(spark, folder, rows, user):
    """Rows of w03_sequential_ids over so many events, and its SQL's."""
    import duckdb

    spark.sql(f"SELECT id AS event_id, {user} AS user_id, timestamp_micros(1705320000000000) AS ts, 1D AS value FROM range({rows})").write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{folder}/events.parquet/*.parquet'")
    return catalog.queries()["w03_sequential_ids"](spark, str(folder)).collect(), con.execute(catalog.oracle_sql()["w03_sequential_ids"]).fetchall()


def test_no_name_without_a_scene(spark, tmp_path):
    got, want = _names(spark, tmp_path, 500, "CASE WHEN id % 10 <> 3 THEN id END")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert [r.vessel for r in got if r.scene_id is None] == [None]


def test_ten_thousand_names_of_a_scene_stay_different(spark, tmp_path):
    """The SQL's lpad cuts numbers to four digits: its rows are the same up to 9999 only."""
    got, want = _names(spark, tmp_path, 15000, "id * 4")
    first = sorted(r.vessel for r in got if r.scene_id == 0)
    assert len(first) > 10000 and first == sorted(f"scene0_vessel_{i:04d}" for i in range(len(first)))
    sql = {r[0]: r[2] for r in want}
    assert len(sql) == len(got) and all(sql[r.detect_id] == r.vessel[:len("scene0_vessel_") + 4] for r in got)
