"""Density clusters and connected regions, on grid cells and label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagos.operators.graph import connected_components
from pelagos.operators.spatial import cell_join, renamed
from pelagos.session import cut


def dbscan(points: DataFrame, eps: float, least: int = 3) -> DataFrame:
    """points(id, x, y) -> id, cluster: the least core id of the cluster, -1 for noise. A core
    has `least` points within eps, itself included; a border point goes to the smallest cluster."""
    d = F.sqrt(F.pow(F.col("x_a") - F.col("x_b"), 2) + F.pow(F.col("y_a") - F.col("y_b"), 2))
    p = points.select("id", "x", "y")
    near = cut(cell_join(renamed(p, "_a"), renamed(p, "_b"), "y_a", "x_a", "y_b", "x_b", float(eps), float(eps), d <= eps).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")), "near")
    core = cut(near.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select(F.col("a").alias("id")), "cores")
    inner = near.join(core.withColumnRenamed("id", "a"), "a").join(core.withColumnRenamed("id", "b"), "b").filter("a <> b")
    parts = connected_components(inner.select("a", "b"))
    label = cut(core.join(parts, "id", "left").select("id", F.coalesce("component", "id").alias("cluster")), "labels")
    border = near.join(label.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("cluster").alias("near_cluster"))
    return p.select("id").join(label, "id", "left").join(border, "id", "left").select("id", F.coalesce("cluster", "near_cluster", F.lit(-1)).alias("cluster"))


def regions(cells: DataFrame, width: int) -> DataFrame:
    """cells(cx, cy) of water -> id, component of the 8-connected regions; id = cy * width + cx."""
    c = cells.select((F.col("cy") * width + F.col("cx")).alias("a"), "cx", "cy")
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i, j in ((1, 0), (-1, 1), (0, 1), (1, 1))]))
    n = c.withColumn("s", steps).select("a", (F.col("cx") + F.col("s.dx")).alias("cx"), (F.col("cy") + F.col("s.dy")).alias("cy"))
    edges = n.join(c.withColumnRenamed("a", "b"), ["cx", "cy"]).select("a", "b")
    parts = connected_components(edges)
    return c.select(F.col("a").alias("id"), "cx", "cy").join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))


def region_stats(labelled: DataFrame, pixels: int = 1) -> DataFrame:
    """Area, box and class of each region; small ones are dropped by the caller."""
    return labelled.groupBy("component").agg((F.count(F.lit(1)) * pixels).alias("area"), F.min("cx").alias("x0"), F.min("cy").alias("y0"), F.max("cx").alias("x1"), F.max("cy").alias("y1")).withColumn(
        "density", F.col("area") / pixels / ((F.col("x1") - F.col("x0") + 1) * (F.col("y1") - F.col("y0") + 1)))
