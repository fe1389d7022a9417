"""Optimal one-to-one assignment. The candidate graph splits into components first; each one is
solved by shortest augmenting paths over its own pairs, so memory follows the pairs."""

from __future__ import annotations

from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagos.operators.graph import connected_components
from pelagos.operators.spatial import box_pairs


def best_pairs(edges: list[tuple[int, int, float]]) -> dict[int, int]:
    """{left: right} of the largest total gain from (left, right, gain > 0); each may stay alone.
    Shortest augmenting paths with potentials, on a heap; the smaller ids come first."""
    near: dict[int, list[tuple[int, float]]] = {}
    for l, r, g in sorted(edges):
        near.setdefault(l, []).append((r, -g))
    mine: dict[int, int] = {}  # left -> right
    owner: dict[int, int] = {}  # right -> left
    v = dict.fromkeys((r for _, r, _ in edges), 0.0)
    u = {l: min(0.0, min(c for _, c in to)) for l, to in near.items()}
    for start in near:
        base, came = {start: 0.0}, {}  # distance of left nodes, left node before each right one
        dist: dict[int, float] = {}
        heap, end, at = [], None, start
        alone = (-u[start], start)  # the cheapest left node to be left alone
        while True:
            d = base[at]
            for r, c in near[at]:
                if (x := d + c - u[at] - v[r]) < dist.get(r, float("inf")) - 1e-12:
                    dist[r], came[r] = x, at
                    heappush(heap, (x, r))
            alone = min(alone, (d - u[at], at))
            while heap and heap[0][0] > dist[heap[0][1]]:
                heappop(heap)
            if not heap or alone[0] <= heap[0][0]:
                total = alone[0]
                break
            x, r = heappop(heap)
            if r not in owner:
                total, end = x, r
                break
            at = owner[r]
            base[at] = x
        for l, d in base.items():
            u[l] += total - d
        for r, d in dist.items():
            if d < total:
                v[r] -= total - d
        if end is None:  # alone[1] gives up its right node, which the path before it takes
            l = alone[1]
            end = mine.pop(l, None)
            if end is None:
                continue
        while end is not None:
            l = came[end]
            before = mine.get(l)
            mine[l], owner[end] = end, l
            if l == start:
                break
            end = before
    return mine


def assign(pairs: DataFrame, left: str, right: str, gain: str) -> DataFrame:
    """pairs(left, right, gain > 0) -> the one-to-one subset of the largest total gain."""
    nodes = pairs.select((F.col(left) * 2).alias("a"), (F.col(right) * 2 + 1).alias("b"), F.col(left).alias("_l"), F.col(right).alias("_r"), F.col(gain).cast("double").alias("_g"))
    parts = connected_components(nodes.select("a", "b"))
    grouped = nodes.join(parts, nodes.a == parts.id).select("component", "_l", "_r", "_g")

    def solve(df: pd.DataFrame) -> pd.DataFrame:
        most = df.groupby(["_l", "_r"])._g.max()
        return pd.DataFrame(list(best_pairs([(int(l), int(r), g) for (l, r), g in most.items()]).items()), columns=[left, right]).astype("int64")

    return grouped.groupBy("component").applyInPandas(solve, f"{left} long, {right} long")


def one_to_one(pairs: DataFrame, threshold: float) -> DataFrame:
    """Detections and vessels by score; below the threshold a dummy is better."""
    good = pairs.filter(F.col("total") >= threshold)
    best = assign(good.withColumn("_gain", F.col("total") - threshold + 1e-6), "detect_id", "mmsi", "_gain")
    return good.join(best, ["detect_id", "mmsi"])


def match_points(truth: DataFrame, pred: DataFrame, tolerance: float = 20.0) -> DataFrame:
    """scene_id -> tp, fp, fn: points (scene_id, id, x, y) closer than the tolerance, one to one,
    as many as possible and the nearest of these. They meet on cells of the tolerance's side."""
    from pelagos.operators.spatial import cell_join

    a = truth.select(F.col("scene_id").alias("sa"), F.col("id").alias("gt"), F.col("x").alias("xa"), F.col("y").alias("ya"))
    b = pred.select(F.col("scene_id").alias("sb"), F.col("id").alias("pr"), F.col("x").alias("xb"), F.col("y").alias("yb"))
    d = F.sqrt(F.pow(F.col("xa") - F.col("xb"), 2) + F.pow(F.col("ya") - F.col("yb"), 2))
    pairs = cell_join(a, b, "ya", "xa", "yb", "xb", tolerance, tolerance, (F.col("sa") == F.col("sb")) & (d < tolerance)).withColumn("gain", 99999 - d)
    hits = assign(pairs, "gt", "pr", "gain").join(a, "gt").groupBy(F.col("sa").alias("scene_id")).agg(F.count(F.lit(1)).alias("tp"))
    return counts(truth, pred, hits)


def match_boxes(truth: DataFrame, pred: DataFrame) -> DataFrame:
    """scene_id -> tp, fp, fn: boxes that touch, one to one, as many as possible. They meet in the
    tiles that both cover."""
    box = ("x1", "y1", "x2", "y2")
    both = truth.select("scene_id", (F.col("id") * 2).alias("k"), *box).union(pred.select("scene_id", F.col("id") * 2 + 1, *box))
    touch = F.expr("x1_a <= x2_b AND y1_a <= y2_b AND x2_a >= x1_b AND y2_a >= y1_b") & (F.col("k_a") % 2 != F.col("k_b") % 2)
    met = box_pairs(both, "k", touch, box=box, also=("scene_id",))
    one = F.col("k_a") % 2 == 0
    gt, pr = F.when(one, F.col("k_a")).otherwise(F.col("k_b")), F.when(one, F.col("k_b")).otherwise(F.col("k_a"))
    pairs = met.select(F.expr("scene_id_a").alias("scene_id"), F.shiftright(gt, 1).alias("gt"), F.shiftright(pr, 1).alias("pr"), F.lit(1.0).alias("gain"))
    scene = truth.select(F.col("id").alias("gt"), "scene_id")
    hits = assign(pairs, "gt", "pr", "gain").join(scene, "gt").groupBy("scene_id").agg(F.count(F.lit(1)).alias("tp"))
    return counts(truth, pred, hits)


def counts(truth: DataFrame, pred: DataFrame, hits: DataFrame) -> DataFrame:
    n = truth.select("scene_id", F.lit(1).alias("g"), F.lit(0).alias("p")).union(pred.select("scene_id", F.lit(0), F.lit(1))).groupBy("scene_id").agg(F.sum("g").alias("g"), F.sum("p").alias("p"))
    out = n.join(hits, "scene_id", "left").withColumn("tp", F.coalesce("tp", F.lit(0)))
    return out.select("scene_id", "tp", (F.col("p") - F.col("tp")).alias("fp"), (F.col("g") - F.col("tp")).alias("fn"))
