"""The flagship and its parts: prediction, gate, scores, choice, decision."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagos.operators import correlate as K
from pelagos.plans.adapters import T_US, cte, hav, view
from pelagos.plans.catalog import query

_SCORES = """
CASE WHEN d > 500e0 THEN 0e0 ELSE exp(-d / 200e0) END AS position_score,
CASE WHEN heading_degrees IS NULL OR heading IS NULL OR sog < 1e0 THEN 0.5e0 ELSE exp(-least(abs(heading_degrees - heading), 360e0 - abs(heading_degrees - heading)) / 45e0) END AS heading_score,
CASE WHEN vessel_length_m IS NULL OR len_f IS NULL THEN 0.5e0 WHEN vessel_length_m < 0.5e0 * len_f THEN 0e0
  WHEN abs(vessel_length_m - len_f) / greatest(len_f, 1e0) > 0.3e0 OR abs(vessel_width_m - wid_f) / greatest(wid_f, 1e0) > 0.3e0 THEN 0e0
  ELSE exp(-(abs(vessel_length_m - len_f) / greatest(len_f, 1e0) + abs(vessel_width_m - wid_f) / greatest(wid_f, 1e0)) / 2e0) END AS size_score,
coalesce(exp(-abs(vessel_speed_k - sog) / 10e0), 0.5e0) AS speed_score,
CASE WHEN vessel_type IS NULL THEN 0.5e0 WHEN vessel_type = 'fishing' THEN CASE WHEN vtype = 30 THEN 0.9e0 WHEN vtype IN (36, 37) THEN 0.6e0 WHEN vtype = 70 THEN 0e0 ELSE 0.3e0 END
  WHEN vessel_type = 'cargo' THEN CASE WHEN vtype BETWEEN 70 AND 79 THEN 0.9e0 WHEN vtype = 30 THEN 0.2e0 ELSE 0.5e0 END ELSE 0.4e0 END AS type_score,
exp(-(gap_s / 60e0) / 30e0) AS temporal_score"""


_WEIGHTS = ("position", 0.25), ("heading", 0.15), ("size", 0.35), ("speed", 0.1), ("type", 0.1), ("temporal", 0.05)
_V1 = ("position", 0.4), ("heading", 0.2), ("size", 0.2), ("speed", 0.1), ("type", 0.05), ("temporal", 0.05)
_POSITION = "CASE WHEN d > 500e0 THEN 0e0 ELSE exp(-d / 200e0) END"
_UNSURE = "300e0 + least(CASE WHEN vtype BETWEEN 30 AND 39 THEN 10e0 WHEN vtype BETWEEN 70 AND 79 THEN 30e0 WHEN vtype BETWEEN 50 AND 59 THEN 20e0 ELSE 15e0 END * gap_s / 60e0, 5000e0)"


def _pairs(h: int, v1: bool = False) -> str:
    scores = _SCORES.replace(_POSITION, f"exp(-d / ({_UNSURE} + 100e0) / 2e0)") if v1 else _SCORES
    return cte("duck", "det", f"pred{h}") + f""", p AS (SELECT detect_id, mmsi, confidence, vessel_length_m, len_f, gap_s, {hav('det.lat', 'det.lon', 'plat', 'plon')} AS d,
  heading_degrees, heading, p.sog AS sog, vessel_width_m, wid_f, vessel_speed_k, vessel_type, vtype FROM det JOIN pred{h} p ON abs(det.lat - plat) < 0.1e0 AND abs(det.lon - plon) < 0.1e0),
g AS (SELECT *, {scores} FROM p WHERE d <= least(least(400e0 + 10e0 * gap_s / 60e0, 800e0), 2000e0)),
s AS (SELECT *, {" + ".join(f"{k}_score * {w}e0" for k, w in (_V1 if v1 else _WEIGHTS))} AS total FROM g)"""


def _flagship(h: int, v1: bool = False) -> str:
    s6 = ", ".join(f"round(coalesce({k}_score, 0e0), 6) AS {k}_score" for k in ("position", "heading", "size", "speed", "type", "temporal"))
    return _pairs(h, v1) + f""", b AS (SELECT *, row_number() OVER (PARTITION BY detect_id ORDER BY CASE WHEN confidence < 0.6e0 THEN 0e0 ELSE total END DESC, mmsi) AS rn FROM s WHERE confidence < 0.6e0 OR total IS NOT NULL),
k AS (SELECT *, coalesce(least(total, 1e0) >= 0.5e0, false) AND NOT coalesce(vessel_length_m > 0 AND len_f > 0 AND greatest(vessel_length_m, len_f) / least(vessel_length_m, len_f) > 2, false) AND d <= 1000e0 AS ok FROM b WHERE rn = 1)
SELECT det.detect_id, round(det.lat, 6) AS lat, round(det.lon, 6) AS lon, round(det.confidence, 6) AS confidence, CASE WHEN ok THEN mmsi END AS matched_mmsi,
  round(CASE WHEN ok THEN least(total, 1e0) ELSE 0e0 END, 6) AS match_confidence, round(gap_s / 60e0, 4) AS time_gap_minutes, round(d, 4) AS distance_meters, {s6},
  CASE WHEN ok THEN false ELSE true END AS is_dark_ship, false AS is_ambiguous FROM det LEFT JOIN k ON k.detect_id = det.detect_id"""


def _rounded(df):
    r = {"lat": 6, "lon": 6, "confidence": 6, "match_confidence": 6, "time_gap_minutes": 4, "distance_meters": 4}
    r |= {k + "_score": 6 for k in ("position", "heading", "size", "speed", "type", "temporal")}
    return df.withColumns({k: F.round(k, n) for k, n in r.items()})


def _run(hours, **kw):
    def run(spark, d):
        return _rounded(K.correlate(view(spark, d, "det"), view(spark, d, "ais"), T_US, K.Options(hours=hours, **kw), fallback_hours=None))
    return run


query("flagship_correlate_72h", _flagship(72))(_run(72))
query("flagship_correlate_2h", _flagship(2))(_run(2))
query("flagship_strict")(_run(72, mode="strict"))
query("flagship_v1_constants", _flagship(72, v1=True))(_run(72, params="v1"))


@query("j08_nearest_in_time", cte("duck", "clean72") + "SELECT mmsi, seq, us, vtype, round(gap_s, 6) AS gap_s FROM clean72")
def nearest(spark, d):
    return K.clean_reports(view(spark, d, "ais"), T_US, 72).select("mmsi", "seq", "us", "vtype", F.round("gap_s", 6).alias("gap_s"))


@query("a01_a02_p02_fill_sizes", cte("duck", "fill72") + "SELECT mmsi, round(len_f, 4) AS len_f, round(wid_f, 4) AS wid_f, round(heading, 4) AS heading, vtype FROM fill72")
def fill(spark, d):
    return K.clean_reports(view(spark, d, "ais"), T_US, 72).select("mmsi", F.round("len_f", 4).alias("len_f"), F.round("wid_f", 4).alias("wid_f"), F.round("heading", 4).alias("heading"), "vtype")


@query("m03_m06_predicted_positions", cte("duck", "pred72") + """SELECT mmsi, round(plat, 6) AS plat, round(plon, 6) AS plon,
 round(""" + _UNSURE + ", 4) AS uncertainty_m FROM pred72")
def predicted(spark, d):
    p = K.predict(K.clean_reports(view(spark, d, "ais"), T_US, 72))
    return p.select("mmsi", F.round("plat", 6).alias("plat"), F.round("plon", 6).alias("plon"), F.round("uncertainty_m", 4).alias("uncertainty_m"))


def _reports(spark, d):
    return K.predict(K.clean_reports(view(spark, d, "ais"), T_US, 72))


@query("j01_radius_join", _pairs(72) + " SELECT detect_id, mmsi, round(d, 4) AS distance_m FROM g")
def radius(spark, d):
    return K.candidates(view(spark, d, "det"), _reports(spark, d)).select("detect_id", "mmsi", F.round("distance_m", 4).alias("distance_m"))


@query("c01_c07_scores", _pairs(72) + " SELECT detect_id, mmsi, round(position_score, 6) AS position_score, round(heading_score, 6) AS heading_score, round(size_score, 6) AS size_score, round(speed_score, 6) AS speed_score, round(type_score, 6) AS type_score, round(temporal_score, 6) AS temporal_score, round(total, 6) AS total FROM s")
def scores(spark, d):
    df = K.scored(K.candidates(view(spark, d, "det"), _reports(spark, d)))
    cols = [k + "_score" for k in ("position", "heading", "size", "speed", "type", "temporal")] + ["total"]
    return df.select("detect_id", "mmsi", *[F.round(c, 6).alias(c) for c in cols])


@query("a04_match_statistics", f"SELECT count(*) AS total, count(matched_mmsi) AS correlated, count(*) - count(matched_mmsi) AS dark, round(100e0 * count(matched_mmsi) / count(*), 6) AS match_rate FROM ({_flagship(72)}) q")
def stats(spark, d):
    return _run(72)(spark, d).agg(F.count(F.lit(1)).alias("total"), F.count("matched_mmsi").alias("correlated"), F.count_if("is_dark_ship").alias("dark"), F.round(100.0 * F.count("matched_mmsi") / F.count(F.lit(1)), 6).alias("match_rate"))


@query("a05_audit_statistics", f"SELECT round(min(distance_meters), 4) AS min_d, round(max(distance_meters), 4) AS max_d, round(avg(distance_meters), 3) AS avg_d, round(min(match_confidence), 6) AS min_c, round(max(match_confidence), 6) AS max_c, count(CASE WHEN distance_meters > 1000 OR match_confidence > 1 THEN 1 END) AS suspicious FROM ({_flagship(72)}) q WHERE matched_mmsi IS NOT NULL")
def audit(spark, d):
    m = _run(72)(spark, d).filter("matched_mmsi IS NOT NULL")
    return m.agg(F.min("distance_meters").alias("min_d"), F.max("distance_meters").alias("max_d"), F.round(F.avg("distance_meters"), 3).alias("avg_d"), F.min("match_confidence").alias("min_c"), F.max("match_confidence").alias("max_c"), F.count_if((F.col("distance_meters") > 1000) | (F.col("match_confidence") > 1)).alias("suspicious"))


@query("a28_global_score", f"SELECT round(sum(match_confidence) / count(*), 6) AS global_score FROM ({_flagship(72)}) q")
def global_score(spark, d):
    return K.global_score(_run(72)(spark, d)).select(F.round("global_score", 6).alias("global_score"))


@query("a15_component_means", "SELECT " + ", ".join(f"round(avg({k}_score), 5) AS {k}" for k in ("position", "heading", "size", "speed", "type", "temporal")) + f" FROM ({_flagship(72)}) q WHERE matched_mmsi IS NOT NULL")
def component_means(spark, d):
    m = _run(72)(spark, d).filter("matched_mmsi IS NOT NULL")
    return m.agg(*[F.round(F.avg(k + "_score"), 5).alias(k) for k in ("position", "heading", "size", "speed", "type", "temporal")])


@query("f22_status_filters", f"""SELECT count(CASE WHEN matched_mmsi IS NOT NULL THEN 1 END) AS matched, count(CASE WHEN match_confidence > 1 THEN 1 END) AS over_one, count(CASE WHEN distance_meters > 1000 THEN 1 END) AS far,
 count(CASE WHEN matched_mmsi IS NOT NULL AND position_score = 0 THEN 1 END) AS no_position, count(CASE WHEN distance_meters > 1000 AND position_score > 0.8e0 THEN 1 END) AS far_but_near FROM ({_flagship(72)}) q""")
def status(spark, d):
    c = F.count_if
    return _run(72)(spark, d).agg(c(F.col("matched_mmsi").isNotNull()).alias("matched"), c(F.col("match_confidence") > 1).alias("over_one"), c(F.col("distance_meters") > 1000).alias("far"),
                                  c(F.col("matched_mmsi").isNotNull() & (F.col("position_score") == 0)).alias("no_position"), c((F.col("distance_meters") > 1000) & (F.col("position_score") > 0.8)).alias("far_but_near"))


@query("u06_modes_compared")
def modes(spark, d):
    one = lambda name, df: df.agg(F.lit(name).alias("run"), F.count("matched_mmsi").alias("matched"), F.round(F.max("match_confidence"), 6).alias("best"))
    return one("compat", _run(72)(spark, d)).union(one("strict", _run(72, mode="strict")(spark, d)))


FLAGSHIP_SQL = _flagship(72)
results = _run(72)
