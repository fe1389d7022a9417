"""Greedy suppression: kept rows, best first, suppress the worse rows in conflict with them.

The result is the lexicographically first independent set by (score desc, id). Each round
keeps the undecided rows without a better undecided neighbour and drops their neighbours;
conflicts come from a grid-cell join, every round is written to the shared folder. Nothing is
gathered by scene, so a scene may be of any size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagos.functions.geo import iou
from pelagos.operators.spatial import box_pairs, cell_join, renamed
from pelagos.session import cut, release


def independent(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """rows(id, ...) that stay, given edges(winner, loser) of conflicts."""
    live, gone = cut(edges.select("winner", "loser").distinct(), "conflicts"), []
    while not live.isEmpty():
        top = live.select("winner").distinct().join(live.select(F.col("loser").alias("winner")).distinct(), "winner", "left_anti")
        drop = cut(live.join(top, "winner").select(F.col("loser").alias("id")).distinct(), "dropped")
        gone.append(drop)
        # the losers of a top row are dropped, so its edges go with them
        rest = live.join(drop.withColumnRenamed("id", "winner"), "winner", "left_anti").join(drop.withColumnRenamed("id", "loser"), "loser", "left_anti")
        before, live = live, cut(rest, "conflicts")
        release(before)
    return rows.join(reduce(DataFrame.union, gone), "id", "left_anti") if gone else rows


def _edges(pairs: DataFrame, score: str) -> DataFrame:
    """The better of a pair wins: higher score, then lower id."""
    a = (F.col(score + "_a") > F.col(score + "_b")) | ((F.col(score + "_a") == F.col(score + "_b")) & (F.col("id_a") < F.col("id_b")))
    return pairs.select(F.when(a, F.col("id_a")).otherwise(F.col("id_b")).alias("winner"), F.when(a, F.col("id_b")).otherwise(F.col("id_a")).alias("loser"))


def distance_nms(rows: DataFrame, threshold: float, x: str = "x", y: str = "y", score: str = "score", group: str | None = None, closed: bool = True) -> DataFrame:
    """rows(id, x, y, score): a kept row suppresses those within the threshold."""
    d = F.sqrt(F.pow(F.col(x + "_a") - F.col(x + "_b"), 2) + F.pow(F.col(y + "_a") - F.col(y + "_b"), 2))
    on = (F.col("id_a") < F.col("id_b")) & ((d <= threshold) if closed else (d < threshold))
    if group:
        on &= F.col(group + "_a") == F.col(group + "_b")
    pairs = cell_join(renamed(rows, "_a"), renamed(rows, "_b"), y + "_a", x + "_a", y + "_b", x + "_b", float(threshold), float(threshold), on)
    return independent(rows, _edges(pairs, score))


def iou_nms(rows: DataFrame, threshold: float, score: str = "score", clip: bool = True, group: str | None = None) -> DataFrame:
    """rows(id, bbox_x1 .. bbox_y2, score) with whole pixels; clip makes sides of at least 1."""
    r = rows
    if clip:
        r = rows.withColumn("bbox_x2", F.greatest("bbox_x2", F.col("bbox_x1") + 1)).withColumn("bbox_y2", F.greatest("bbox_y2", F.col("bbox_y1") + 1))
    box = ("bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2")
    over = iou(*[c + "_a" for c in box], *[c + "_b" for c in box]) > threshold
    return independent(rows, _edges(box_pairs(r, "id", over, also=(group,) if group else ()), score))


def quality(score: str = "score", priority: Column | None = None) -> Column:
    """Score with bonuses for small-vessel strategies and known sizes, 1 at most."""
    bonus = F.coalesce((4 - priority) * 0.1, F.lit(0.0)) if priority is not None else F.lit(0.0)
    return F.least(F.col(score) + bonus + F.when(F.col("vessel_length_m") > 0, 0.1).otherwise(0.0) + F.when(F.col("vessel_width_m") > 0, 0.1).otherwise(0.0), F.lit(1.0))


def weighted_merge(rows: DataFrame, radius: float = 0.001, compat: bool = True) -> DataFrame:
    """rows(id, lon, lat, score, quality, vessel_*): best quality first, a primary takes the rows
    in its radius that no better primary took; coordinates are means weighted by quality (compat
    counts the primary twice), score the maximum, sizes means of positive values."""
    d = F.sqrt(F.pow(F.col("lon_a") - F.col("lon_b"), 2) + F.pow(F.col("lat_a") - F.col("lat_b"), 2))
    slim = rows.select("id", "lon", "lat", "quality")
    pairs = cut(cell_join(renamed(slim, "_a"), renamed(slim, "_b"), "lat_a", "lon_a", "lat_b", "lon_b", radius, radius, (F.col("id_a") < F.col("id_b")) & (d < radius)), "near")
    edges = _edges(pairs, "quality")
    primary = cut(independent(slim, edges), "primaries")
    take = edges.join(primary.select(F.col("id").alias("winner"), F.col("quality").alias("q")), "winner")
    taken = take.groupBy("loser").agg(F.max(F.struct("q", (-F.col("winner")).alias("w"))).alias("m")).select(F.col("loser").alias("id"), (-F.col("m.w")).alias("primary"))
    own = primary.select("id", F.col("id").alias("primary"))
    members = own.union(taken.join(primary, "id", "left_anti").select("id", "primary"))
    if compat:
        members = members.union(own)
    m = members.join(rows, "id")
    pos = lambda c: F.avg(F.when(F.col(c) > 0, F.col(c)))
    return m.groupBy("primary").agg((F.sum(F.col("lon") * F.col("quality")) / F.sum("quality")).alias("lon"), (F.sum(F.col("lat") * F.col("quality")) / F.sum("quality")).alias("lat"), F.max("score").alias("score"),
                                    pos("vessel_length_m").alias("vessel_length_m"), pos("vessel_width_m").alias("vessel_width_m"), pos("vessel_speed_k").alias("vessel_speed_k"), F.count(F.lit(1)).alias("members")).withColumnRenamed("primary", "id")


def multi_scale_merge(rows: DataFrame, window: str = "window_size", most: float = 400.0) -> DataFrame:
    """rows(id, px_row, px_col, score, threshold, vessel_*): best score first, a row groups all rows
    in its box of +- threshold; the group's best by quality stands for it."""
    near = (F.abs(F.col("px_row_a") - F.col("px_row_b")) <= F.col("threshold_a")) & (F.abs(F.col("px_col_a") - F.col("px_col_b")) <= F.col("threshold_a"))
    better = (F.col("score_a") > F.col("score_b")) | ((F.col("score_a") == F.col("score_b")) & (F.col("id_a") < F.col("id_b")))
    slim = rows.select("id", "px_row", "px_col", "score", "threshold")
    pairs = cut(cell_join(renamed(slim, "_a"), renamed(slim, "_b"), "px_row_a", "px_col_a", "px_row_b", "px_col_b", most, most, (F.col("id_a") != F.col("id_b")) & near), "near")
    heads = independent(slim, pairs.filter(better).select(F.col("id_a").alias("winner"), F.col("id_b").alias("loser")))
    heads = cut(heads.select("id"), "heads")
    members = heads.select(F.col("id").alias("head"), "id").union(pairs.join(heads.withColumnRenamed("id", "id_a"), "id_a").select(F.col("id_a").alias("head"), F.col("id_b").alias("id")))
    bonus = F.col("score") + F.when(F.col("vessel_length_m") > 0, 0.1).otherwise(0.0) + F.when(F.col("vessel_width_m") > 0, 0.1).otherwise(0.0) + (1024 - F.col(window)) / 1024 * 0.1
    ranked = members.join(rows, "id").withColumn("bonus", bonus)
    return ranked.groupBy("head").agg(F.max(F.struct("bonus", "score", (-F.col("id")).alias("neg"))).alias("m")).select("head", (-F.col("m.neg")).alias("best"), F.col("m.score").alias("score"))
