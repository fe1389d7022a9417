"""Spatial joins. cell_join turns a radius or near-coordinate condition into an equi join on grid
cells with an exact residual, so no side is broadcast unchecked and no cross product is made."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagos.functions.geo import EARTH_M


def _cells(lat: str, lon: str, dlat: float, dlon: float, ring: bool) -> Column:
    y, x = F.floor(F.col(lat) / dlat), F.floor(F.col(lon) / dlon)
    if not ring:
        return F.array(F.struct(y.alias("y"), x.alias("x")))
    return F.array(*[F.struct((y + i).alias("y"), (x + j).alias("x")) for i in (-1, 0, 1) for j in (-1, 0, 1)])


def cell_join(a: DataFrame, b: DataFrame, lat_a: str, lon_a: str, lat_b: str, lon_b: str, dlat: float, dlon: float, condition: Column, how: str = "inner") -> DataFrame:
    """Rows of a and b (no column in common) whose cells of dlat x dlon degrees touch and that
    meet the condition. b goes into its 3 x 3 cells, a into its own, so a pair meets once."""
    left = a.withColumn("_cell", _cells(lat_a, lon_a, dlat, dlon, False)[0])
    right = b.withColumn("_cell_b", F.explode(_cells(lat_b, lon_b, dlat, dlon, True)))
    return left.join(right, (F.col("_cell") == F.col("_cell_b")) & condition, how).drop("_cell", "_cell_b")


def _cube(lat: str, lon: str, side_m: float) -> list[Column]:
    y, x = F.radians(F.col(lat)), F.radians(F.col(lon))
    return [F.floor(v * (EARTH_M / side_m)).cast("long") for v in (F.cos(y) * F.cos(x), F.cos(y) * F.sin(x), F.sin(y))]


def radius_join(a: DataFrame, b: DataFrame, lat_a: str, lon_a: str, lat_b: str, lon_b: str, radius_m: float, condition: Column, how: str = "inner") -> DataFrame:
    """cell_join for great-circle distances up to radius_m, at every latitude and across the
    antimeridian: cells are cubes about the points of the sphere, whose chords are no longer
    than their arcs. b goes into its 27 cubes, a into its own, so a pair meets once."""
    side = radius_m * 1.001  # above the rounding of coordinates
    x, y, z = _cube(lat_b, lon_b, side)
    ring = F.array(*[F.struct((x + i).alias("x"), (y + j).alias("y"), (z + k).alias("z")) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])
    left = a.withColumn("_cell", F.struct(*[c.alias(n) for n, c in zip("xyz", _cube(lat_a, lon_a, side))]))
    return left.join(b.withColumn("_cell_b", F.explode(ring)), (F.col("_cell") == F.col("_cell_b")) & condition, how).drop("_cell", "_cell_b")


def renamed(df: DataFrame, suffix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c + suffix) for c in df.columns])


def box_pairs(df: DataFrame, key: str, condition: Column, side: int = 128, box=("bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2"), also: tuple[str, ...] = ()) -> DataFrame:
    """Pairs _a.key < _b.key of overlapping boxes that meet the condition on columns x_a, x_b:
    boxes meet in the tiles that both cover, and a pair counts in the first of these alone."""
    x1, y1, x2, y2 = box
    tiles = df.withColumn("_tx", F.explode(F.sequence(F.floor(F.col(x1) / side), F.floor(F.col(x2) / side)))).withColumn("_ty", F.explode(F.sequence(F.floor(F.col(y1) / side), F.floor(F.col(y2) / side))))
    a, b = renamed(tiles, "_a"), renamed(tiles, "_b")
    on = (F.col("_tx_a") == F.col("_tx_b")) & (F.col("_ty_a") == F.col("_ty_b")) & (F.col(key + "_a") < F.col(key + "_b"))
    for c in also:
        on &= F.col(c + "_a") == F.col(c + "_b")
    first = (F.col("_tx_a") == F.floor(F.greatest(x1 + "_a", x1 + "_b") / side)) & (F.col("_ty_a") == F.floor(F.greatest(y1 + "_a", y1 + "_b") / side))
    return a.join(b, on & first & condition)


def avoid_filter(det: DataFrame, avoid: DataFrame, strict: bool = False) -> DataFrame:
    """Range anti join: detections in the square of no location stay; null coordinates stay.
    compat takes the cosine of degrees, so some squares are empty. Squares and detections meet on
    one-degree cells."""
    from pelagos.functions.geo import square_bounds

    locations = avoid.select(*[v.alias("_" + k) for k, v in square_bounds("alat", "alon", "width_m", strict).items()])
    inside = F.col("lat").between(F.col("_min_lat"), F.col("_max_lat")) & F.col("lon").between(F.col("_min_lon"), F.col("_max_lon"))
    full = locations.filter("_min_lat <= _max_lat AND _min_lon <= _max_lon")
    cells = full.withColumn("_cy", F.explode(F.sequence(F.floor("_min_lat"), F.floor("_max_lat")))).withColumn("_cx", F.explode(F.sequence(F.floor("_min_lon"), F.floor("_max_lon"))))
    return det.join(cells, (F.floor("lat") == F.col("_cy")) & (F.floor("lon") == F.col("_cx")) & inside, "left_anti")


def nearest_point(points: DataFrame, to: DataFrame, distance: Column, key: str, block: int = 10_000) -> DataFrame:
    """Least distance of each point to a fixed set (a coast line). The set is broadcast in blocks
    of at most `block` targets, and each block's minima are combined before the shuffle."""
    to = to.distinct()
    parts = -(-to.count() // block)
    slot = F.pmod(F.xxhash64(*to.columns), F.lit(2 * parts))  # twice as many as needed, so that none goes over
    some = [to] if parts <= 1 else [to.filter(slot == i) for i in range(2 * parts)]
    best = [points.join(F.broadcast(t)).groupBy(key).agg(F.min(distance).alias("min_distance")) for t in some]
    return reduce(DataFrame.unionByName, best).groupBy(key).agg(F.min("min_distance").alias("min_distance"))


def grid_index(df: DataFrame, x: tuple[str, str], y: tuple[str, str], side: int) -> DataFrame:
    """A row for each cell that a rectangle covers."""
    return df.withColumn("gx", F.explode(F.expr(f"sequence(cast(floor({x[0]} / {side}) as long), cast(floor({x[1]} / {side}) as long))"))).withColumn("gy", F.explode(F.expr(f"sequence(cast(floor({y[0]} / {side}) as long), cast(floor({y[1]} / {side}) as long))")))


def grid_search(index: DataFrame, query: DataFrame, data: str, side: int) -> DataFrame:
    """Data of all cells that a query rectangle (q, qx1, qy1, qx2, qy2) touches, each once."""
    q = grid_index(query, ("qx1", "qx2"), ("qy1", "qy2"), side)
    return q.join(index, ["gx", "gy"]).select("q", data).distinct()


def all_pairs(df: DataFrame, key: str, blocks: int = 16) -> DataFrame:
    """All pairs _a.key < _b.key (key is unique): rows fall into blocks, and each pair of blocks meets by an equi join."""
    slots = df.withColumn("_s", F.pmod(F.xxhash64(key), F.lit(blocks)))
    a = renamed(slots.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), "_a")
    b = renamed(slots.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), "_b")
    return a.join(b, (F.col("_s_a") == F.col("_t_b")) & (F.col("_t_a") == F.col("_s_b")) & (F.col(key + "_a") < F.col(key + "_b")))


def quantiles(df: DataFrame, col: str, probs: list[float], bins: int = 1024, few: int = 10_000) -> list[float | None]:
    """Exact quantiles (linear between neighbours) of the values that aren't null: bins are counted,
    and those that hold a wanted rank are narrowed until they are small, so values are neither
    sorted nor gathered as a whole."""
    rows = df.select(F.col(col).cast("double").alias("v")).filter("v IS NOT NULL")
    n, lo, hi = rows.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    if not n:
        return [None] * len(probs)
    places = [(n - 1) * p for p in probs]
    found: dict[int, float] = {}
    todo = [(rows, lo, hi, n, {k: k for at in places for k in (math.floor(at), math.ceil(at))})]  # wanted rank: rank in rows
    while todo:
        part, low, high, size, ranks = todo.pop()
        if low == high:
            found |= dict.fromkeys(ranks, low)
        elif size <= few:
            values = sorted(r[0] for r in part.collect())
            found |= {k: values[i] for k, i in ranks.items()}
        else:
            bin_ = F.least(F.greatest(F.floor((F.col("v") - low) / ((high - low) / bins)), F.lit(0)), F.lit(bins - 1))
            before = 0
            for r in sorted(part.groupBy(bin_.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()):
                if inside := {k: i - before for k, i in ranks.items() if before <= i < before + r.n}:
                    todo.append((part.filter(bin_ == r.k), r.lo, r.hi, r.n, inside))
                before += r.n
    return [found[math.floor(at)] + (at - math.floor(at)) * (found[math.ceil(at)] - found[math.floor(at)]) for at in places]
