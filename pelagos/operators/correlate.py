"""Detections and position reports: clean, predict, gate, score, choose, decide."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pelagos.functions import geo, scoring
from pelagos.operators.spatial import radius_join


@dataclass(frozen=True)
class Options:
    """mode compat keeps the observed behaviour, strict the evident intent; params are a set of
    scoring constants. Neither implies the other."""
    mode: str = "compat"
    params: str = "current"
    hours: float = 2
    max_hours: float = 2
    threshold: float = 0.5
    hard_gate_m: float = 2000.0


def clean_reports(ais: DataFrame, t_us: int, hours: float, fallback_hours: float | None = None) -> DataFrame:
    """One report per vessel: with speed and course, in the closed time window (if that is empty,
    in the fallback's), the nearest in time. Missing headings become courses, types 90, sizes
    the mean of the type, then of all."""
    base = ais.filter(F.col("sog").isNotNull() & F.col("cog").isNotNull())

    def inside(h):
        return base.filter(F.col("us").between(t_us - int(h * 3600e6), t_us + int(h * 3600e6)))

    rows = inside(hours)
    if fallback_hours and rows.isEmpty():
        rows = inside(fallback_hours)
    near = Window.partitionBy("mmsi").orderBy(F.abs(F.col("us") - t_us), "seq")
    rows = rows.withColumn("_rn", F.row_number().over(near)).filter("_rn = 1").drop("_rn")
    rows = rows.withColumn("heading", F.coalesce("heading", "cog")).withColumn("vtype", F.coalesce("vtype", F.lit(90)))
    rows = rows.withColumn("gap_s", F.least(F.greatest((F.lit(t_us) - F.col("us")).cast("double") / 1e6, F.lit(0.0)), F.lit(7200.0)))
    return fill_sizes(rows)


def fill_sizes(rows: DataFrame) -> DataFrame:
    """Missing sizes: the mean of the type, then the mean over all after that. Means come from
    one aggregate by type and joins of that small table, not from a window over all rows."""
    by_type = rows.groupBy("vtype").agg(F.avg("length").alias("_tl"), F.avg("width").alias("_tw"))
    filled = rows.join(by_type, "vtype", "left").withColumn("_l", F.coalesce("length", "_tl")).withColumn("_w", F.coalesce("width", "_tw"))
    means = filled.agg(F.avg("_l").alias("_ml"), F.avg("_w").alias("_mw"))
    return filled.join(F.broadcast(means)).withColumn("len_f", F.coalesce("_l", "_ml")).withColumn("wid_f", F.coalesce("_w", "_mw")).drop("_l", "_w", "_tl", "_tw", "_ml", "_mw")


def predict(reports: DataFrame) -> DataFrame:
    """Great-circle prediction along the heading, with its uncertainty."""
    lat, lon = geo.destination("lat", "lon", "heading", F.col("sog") * geo.KNOT_MS * F.col("gap_s"))
    return reports.withColumn("plat", lat).withColumn("plon", lon).withColumn("minutes", F.col("gap_s") / 60).withColumn("uncertainty_m", geo.uncertainty_m("vtype", F.col("gap_s") / 60))


def candidates(det: DataFrame, pred: DataFrame, options: Options = Options()) -> DataFrame:
    """Pairs inside the gate min(min(400 + 10 t, 800), hard), met on cells of 800 m."""
    d = det.select("detect_id", F.col("lat").alias("dlat"), F.col("lon").alias("dlon"), "confidence", "vessel_length_m", "vessel_width_m", "vessel_speed_k", "vessel_type", "heading_degrees")
    p = pred.select("mmsi", "plat", "plon", "sog", F.col("heading").alias("ais_heading"), "vtype", "len_f", "wid_f", "minutes", "uncertainty_m")
    dist = geo.haversine_m("dlat", "dlon", "plat", "plon")
    gate = F.least(F.least(400.0 + 10.0 * F.col("minutes"), F.lit(800.0)), F.lit(options.hard_gate_m))
    return radius_join(d, p, "dlat", "dlon", "plat", "plon", min(800.0, options.hard_gate_m), dist <= gate).withColumn("distance_m", dist)


def scored(pairs: DataFrame, options: Options = Options()) -> DataFrame:
    s = {
        "position": scoring.position("distance_m", options.params, "uncertainty_m"),
        "heading": scoring.heading("heading_degrees", "ais_heading", "sog", options.mode == "strict"),
        "size": scoring.size("vessel_length_m", "vessel_width_m", "len_f", "wid_f"),
        "speed": scoring.speed("vessel_speed_k", "sog"),
        "type": scoring.type_("vessel_type", "vtype"),
        "temporal": scoring.temporal("minutes"),
    }
    df = pairs.withColumns({k + "_score": v for k, v in s.items()})
    return df.withColumn("total", scoring.total({k: F.col(k + "_score") for k in s}, options.params))


def choose(pairs: DataFrame, options: Options = Options()) -> DataFrame:
    """One candidate for each detection. Below a confidence of 0.6 compat takes the first in
    order of mmsi whatever its score (a null score still scores 0), strict takes none."""
    weak = F.col("confidence") < 0.6
    pairs = pairs.filter(~weak & F.col("total").isNotNull() if options.mode == "strict" else weak | F.col("total").isNotNull())
    best = Window.partitionBy("detect_id").orderBy(F.when(weak, 0.0).otherwise(F.col("total")).desc(), "mmsi")
    return pairs.withColumn("_rn", F.row_number().over(best)).filter("_rn = 1").drop("_rn")


def decide(det: DataFrame, chosen: DataFrame, options: Options = Options()) -> DataFrame:
    """A row for every detection. A size ratio over 2 or a distance over 1 km unmatches, as does
    a confidence under the threshold; distance and scores stay."""
    conf = F.least("total", F.lit(1.0))
    ratio = F.when((F.col("vessel_length_m") > 0) & (F.col("len_f") > 0), F.greatest("vessel_length_m", "len_f") / F.least("vessel_length_m", "len_f"))
    keeps = F.coalesce(conf >= options.threshold, F.lit(False)) & ~F.coalesce(ratio > 2, F.lit(False)) & (F.col("distance_m") <= 1000)
    c = chosen.select("detect_id", F.when(keeps, F.col("mmsi")).alias("matched_mmsi"), F.when(keeps, conf).otherwise(0.0).alias("match_confidence"), F.col("minutes").alias("time_gap_minutes"), F.col("distance_m").alias("distance_meters"),
                      *[k + "_score" for k in ("position", "heading", "size", "speed", "type", "temporal")])
    out = det.select("detect_id", "lat", "lon", "confidence").join(c, "detect_id", "left")
    zero = ["match_confidence"] + [k + "_score" for k in ("position", "heading", "size", "speed", "type", "temporal")]
    return out.withColumns({k: F.coalesce(F.col(k), F.lit(0.0)) for k in zero}).withColumn("is_dark_ship", F.col("matched_mmsi").isNull()).withColumn("is_ambiguous", F.lit(False))


def correlate(det: DataFrame, ais: DataFrame, t_us: int, options: Options = Options(), fallback_hours: float | None = 6) -> DataFrame:
    """The whole flow. The search over time gaps never changes a score, so it isn't made."""
    pred = predict(clean_reports(ais, t_us, options.hours, fallback_hours))
    pairs = scored(candidates(det, pred, options), options)
    if options.mode == "strict":
        from pelagos.operators.assign import one_to_one
        pairs = one_to_one(choose_all(pairs), options.threshold)
        return decide(det, pairs, options)
    return decide(det, choose(pairs, options), options)


def choose_all(pairs: DataFrame) -> DataFrame:
    return pairs.filter((F.col("confidence") >= 0.6) & F.col("total").isNotNull())


def global_score(results: DataFrame) -> DataFrame:
    """Sum of the best scores over the number of detections."""
    return results.agg((F.sum("match_confidence") / F.count(F.lit(1))).alias("global_score"))
