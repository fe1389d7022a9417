"""Vessel tracks: order, split on gaps, interpolate, and the error of interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pelagos.functions import geo


def segments(points: DataFrame, gap_s: float) -> DataFrame:
    """points(mmsi, us, seq, ...) with the number of the segment: a longer gap starts a new one."""
    w = Window.partitionBy("mmsi").orderBy("us", "seq")
    cut = (F.col("us") - F.lag("us").over(w)) > int(gap_s * 1e6)
    return points.withColumn("_cut", F.when(cut, 1).otherwise(0)).withColumn("segment", F.sum("_cut").over(w)).drop("_cut")


def interpolate(points: DataFrame, step_s: int, great_circle: bool = False) -> DataFrame:
    """Positions at whole multiples of step_s between the reports of a segment; linear, or along
    the great circle."""
    w = Window.partitionBy("mmsi", "segment").orderBy("us", "seq")
    step = int(step_s * 1_000_000)
    n = points.withColumn("us2", F.lead("us").over(w)).withColumn("lat2", F.lead("lat").over(w)).withColumn("lon2", F.lead("lon").over(w)).filter("us2 > us")
    first = F.expr(f"(us div {step} + 1) * {step}")
    n = n.withColumn("_first", first).filter("_first < us2").withColumn("at", F.explode(F.expr(f"sequence(_first, us2 - 1, {step}L)")))
    f = (F.col("at") - F.col("us")) / (F.col("us2") - F.col("us")).cast("double")
    if great_circle:
        lat, lon = along(f)
    else:
        lat, lon = F.col("lat") + (F.col("lat2") - F.col("lat")) * f, F.col("lon") + (F.col("lon2") - F.col("lon")) * f
    return n.withColumn("_lat", lat).withColumn("_lon", lon).select("mmsi", "segment", "at", F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))


def along(f) -> tuple:
    """Point at the fraction f of the great circle from (lat, lon) to (lat2, lon2)."""
    la, lo, lb, ob = (F.radians(c) for c in ("lat", "lon", "lat2", "lon2"))
    d = geo.haversine_m("lat", "lon", "lat2", "lon2") / geo.EARTH_M
    a, b = F.when(d < 1e-12, 1 - f).otherwise(F.sin((1 - f) * d) / F.sin(d)), F.when(d < 1e-12, f).otherwise(F.sin(f * d) / F.sin(d))
    x, y, z = a * F.cos(la) * F.cos(lo) + b * F.cos(lb) * F.cos(ob), a * F.cos(la) * F.sin(lo) + b * F.cos(lb) * F.sin(ob), a * F.sin(la) + b * F.sin(lb)
    return F.degrees(F.atan2(z, F.sqrt(x * x + y * y))), F.degrees(F.atan2(y, x))


def leave_one_out_rmse(points: DataFrame) -> DataFrame:
    """Each report against the interpolation between its neighbours."""
    w = Window.partitionBy("mmsi").orderBy("us", "seq")
    n = points
    for c in ("us", "lat", "lon"):
        n = n.withColumn(c + "0", F.lag(c).over(w)).withColumn(c + "2", F.lead(c).over(w))
    f = (F.col("us") - F.col("us0")) / (F.col("us2") - F.col("us0"))
    n = n.filter("us2 > us0").withColumn("m", geo.haversine_m("lat", "lon", F.col("lat0") + (F.col("lat2") - F.col("lat0")) * f, F.col("lon0") + (F.col("lon2") - F.col("lon0")) * f))
    return n.agg(F.sqrt(F.avg(F.pow("m", F.lit(2)))).alias("rmse_m"), F.count(F.lit(1)).alias("points"))
