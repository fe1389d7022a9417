"""Filters over detections and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("fishing", "cargo", "other")


def _no(c: Column) -> Column:
    """Null counts as false, as a comparison with a missing value does."""
    return F.coalesce(c, F.lit(False))


def attribute_count() -> Column:
    tests = (F.col("vessel_length_m") > 0, F.col("vessel_width_m") > 0, F.col("vessel_speed_k") >= 0, F.col("vessel_type").isin(*KINDS), F.col("heading_degrees").between(0, 360), F.col("is_fishing_vessel").isNotNull())
    out = F.lit(0)
    for t in tests:
        out = out + _no(t).cast("int")
    return out


def _stages(confidence: float, attributes: int) -> list[tuple[str, Column]]:
    return [
        ("confidence", _no(F.col("confidence") >= confidence)), ("attributes", attribute_count() >= attributes), ("size", _no(F.col("vessel_length_m").between(5, 500))),
        ("speed", _no(F.col("vessel_speed_k") <= 50)), ("coordinates", _no(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))),
    ]


def quality_filter(det: DataFrame, confidence: float = 0.3, attributes: int = 3) -> DataFrame:
    df = det.withColumn("attribute_count", attribute_count())
    for _, c in _stages(confidence, attributes):
        df = df.filter(c)
    return df


def filter_statistics(det: DataFrame, confidence: float = 0.3, attributes: int = 3) -> DataFrame:
    """Rows left after each stage, in one pass."""
    out, so_far = [F.count(F.lit(1)).alias("total")], F.lit(True)
    for name, c in _stages(confidence, attributes):
        so_far = so_far & c
        out.append(F.count_if(so_far).alias("after_" + name))
    return det.agg(*out, F.round(F.count_if(so_far) / F.count(F.lit(1)).cast("double"), 6).alias("retention"))


def time_window(ais: DataFrame, t_us: int, hours: float, fallback_hours: float | None = None) -> DataFrame:
    """Closed window; where it is empty, the fallback's. One plan: the wider window once, and
    whether the narrow one holds a row as a one-row aggregate."""
    def near(h: float) -> Column:
        return F.col("us").between(t_us - int(h * 3600e6), t_us + int(h * 3600e6))
    if fallback_hours is None:
        return ais.filter(near(hours))
    wide = ais.filter(near(fallback_hours))
    some = ais.filter(near(hours)).agg((F.count(F.lit(1)) > 0).alias("_some"))
    return wide.join(F.broadcast(some)).filter(near(hours) | ~F.col("_some")).drop("_some")


def bounding_box(df: DataFrame, lat0: float, lat1: float, lon0: float, lon1: float) -> DataFrame:
    return df.filter(F.col("lat").between(lat0, lat1) & F.col("lon").between(lon0, lon1))


def within_bounds_of(df: DataFrame, other: DataFrame, margin: float = 0.01) -> DataFrame:
    """Rows inside the bounds of another table's coordinates: a broadcast of one row."""
    b = other.agg((F.min("lat") - margin).alias("_a"), (F.max("lat") + margin).alias("_b"), (F.min("lon") - margin).alias("_c"), (F.max("lon") + margin).alias("_d"))
    return df.join(F.broadcast(b), F.col("lat").between(F.col("_a"), F.col("_b")) & F.col("lon").between(F.col("_c"), F.col("_d"))).drop("_a", "_b", "_c", "_d")


def in_image(row: str, col: str, height: int, width: int) -> Column:
    return (F.col(row) >= 0) & (F.col(row) < height) & (F.col(col) >= 0) & (F.col(col) < width)


def keep_bounds(x: str, y: str, col0: str, row0: str, size: int, padding: int, overlap: int, height: int, width: int) -> Column:
    """A centre inside the window less padding plus overlap; at an image border up to the edge."""
    lo, hi = max(0, padding - overlap), min(size, size - padding + overlap)
    def side(v: str, start: str, whole: int) -> Column:
        return (F.col(v) >= F.when(F.col(start) == 0, 0).otherwise(lo)) & (F.col(v) <= F.when(F.col(start) >= whole - size, size).otherwise(hi))
    return side(x, col0, width) & side(y, row0, height)


def in_overlap(x: Column, y: Column, size: int, overlap: int) -> Column:
    return F.lit(False) if overlap == 0 else (x < overlap) | (x > size - overlap) | (y < overlap) | (y > size - overlap)


def validation_report(det: DataFrame) -> DataFrame:
    """Violations of each rule, all counted in one pass."""
    rules = [
        ("error", "lat_range", ~F.col("lat").between(-90, 90) | F.col("lat").isNull()), ("error", "lon_range", ~F.col("lon").between(-180, 180) | F.col("lon").isNull()),
        ("error", "confidence_range", ~F.col("confidence").between(0, 1) | F.col("confidence").isNull()), ("warning", "length_positive", F.col("vessel_length_m") <= 0),
        ("warning", "speed_range", ~F.col("vessel_speed_k").between(0, 60)), ("warning", "heading_range", ~F.col("heading_degrees").between(0, 360)),
    ]
    once = det.agg(*[F.count_if(c).alias(f"r{i}") for i, (_, _, c) in enumerate(rules)])
    return once.select(F.explode(F.array(*[F.struct(F.lit(a).alias("level"), F.lit(b).alias("rule"), F.col(f"r{i}").alias("violations")) for i, (a, b, _) in enumerate(rules)])).alias("r")).select("r.*")
