"""Rasters as cell tables (cx, cy, values): masks, coverage, tiles, derived channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagos.operators.spatial import quantiles


def coverage(windows: DataFrame, cells: DataFrame, size: Column | int, cell: int = 1) -> DataFrame:
    """Water share of each window (row, col): cells meet windows on blocks of the grid, not by a
    range join; a cell outside the mask counts as land."""
    side = 16
    n = size if isinstance(size, Column) else F.lit(size)
    w = windows.withColumn("_n", n).withColumn("_wy", F.explode(F.sequence(F.floor(F.col("row") / (cell * side)), F.floor((F.col("row") + F.col("_n") - 1) / (cell * side))))).withColumn("_wx", F.explode(F.sequence(F.floor(F.col("col") / (cell * side)), F.floor((F.col("col") + F.col("_n") - 1) / (cell * side)))))
    c = cells.filter("water = 1").select(F.floor(F.col("cy") / side).alias("_wy"), F.floor(F.col("cx") / side).alias("_wx"), (F.col("cy") * cell).alias("_y"), (F.col("cx") * cell).alias("_x"))
    inside = (F.col("_y") >= F.col("row")) & (F.col("_y") < F.col("row") + F.col("_n")) & (F.col("_x") >= F.col("col")) & (F.col("_x") < F.col("col") + F.col("_n"))
    hit = w.join(c, ["_wy", "_wx"]).filter(inside).groupBy("row", "col").agg((F.count(F.lit(1)) * cell * cell).alias("_water"), F.first("_n").alias("_s"))
    return windows.withColumn("_n", n).join(hit.drop("_s"), ["row", "col"], "left").withColumn("water_share", F.coalesce("_water", F.lit(0)) / (F.col("_n") * F.col("_n"))).drop("_water", "_n")


def near_land(points: DataFrame, cells: DataFrame, radius: int, share: float = 0.9) -> DataFrame:
    """Points (id, cx, cy) whose own cell is water and whose half-open box of +- radius cells is
    water to `share` at least. A point is spread over the blocks its box touches."""
    side = 16
    p = points.withColumn("_by", F.explode(F.sequence(F.floor((F.col("cy") - radius) / side), F.floor((F.col("cy") + radius - 1) / side)))).withColumn("_bx", F.explode(F.sequence(F.floor((F.col("cx") - radius) / side), F.floor((F.col("cx") + radius - 1) / side))))
    c = cells.select(F.floor(F.col("cy") / side).alias("_by"), F.floor(F.col("cx") / side).alias("_bx"), F.col("cy").alias("_y"), F.col("cx").alias("_x"), "water")
    box = (F.col("_y") >= F.col("cy") - radius) & (F.col("_y") < F.col("cy") + radius) & (F.col("_x") >= F.col("cx") - radius) & (F.col("_x") < F.col("cx") + radius)
    own = F.max(F.when((F.col("_y") == F.col("cy")) & (F.col("_x") == F.col("cx")), F.col("water")))
    return p.join(c, ["_by", "_bx"]).filter(box).groupBy("id").agg(F.avg("water").alias("share"), own.alias("own")).filter((F.col("own") == 1) & (F.col("share") >= share)).select("id")


def water_mask(cells: DataFrame, zero_share: float = 0.3) -> DataFrame:
    """Water where a band is 0 if over 30 % of them are; else where both bands are below the lower
    quartile of their positive values."""
    if (cells.agg(F.avg(F.when(F.col("vv") == 0, 1.0).otherwise(0.0))).first()[0] or 0.0) > zero_share:
        return cells.withColumn("is_water", F.col("vv") == 0)
    v, h = (quantiles(cells.filter(f"{c} > 0"), c, [0.25])[0] for c in ("vv", "vh"))
    return cells.withColumn("is_water", (F.col("vv") < F.lit(v).cast("double")) & (F.col("vh") < F.lit(h).cast("double")))


def masked(cells: DataFrame) -> DataFrame:
    """Land is set to 0."""
    return cells.withColumns({b: F.when(F.col("water") == 1, F.col(b)).otherwise(0.0) for b in ("vv", "vh")})


def to_byte(col: str, lo: float, hi: float) -> Column:
    return F.floor(F.least(F.greatest((F.col(col) - lo) / (hi - lo), F.lit(0.0)), F.lit(1.0)) * 255)


def derived_channels(cells: DataFrame) -> DataFrame:
    return cells.withColumn("mean_amp", F.sqrt(F.col("vv") * F.col("vh") + 1e-6)).withColumn("ratio", F.least(F.col("vv") / (F.col("vh") + 1e-6) * 50, F.lit(255.0)))


def stitch(windows: DataFrame, tiles: DataFrame, width: int, height: int, side: int = 512) -> DataFrame:
    """Tiles of each window (id, row_px, col_px); a missing tile stays with a null payload (zeros)."""
    def span(a: str, n: int) -> str:
        return f"sequence(cast(floor({a} / {side}) as long), cast(floor(({a} + {n} - 1) / {side}) as long))"
    w = windows.withColumn("tile_col", F.explode(F.expr(span("col_px", width)))).withColumn("tile_row", F.explode(F.expr(span("row_px", height))))
    return w.join(tiles, ["tile_col", "tile_row"], "left")


def best_offset(a: DataFrame, b: DataFrame, steps: tuple[int, ...] = (-2, 1)) -> DataFrame:
    """The shift of b against a that maximises the mean product of their values."""
    shifts = F.explode(F.array(*[F.struct(F.lit(i).alias("dy"), F.lit(j).alias("dx")) for i in steps for j in steps]))
    moved = b.withColumn("s", shifts).select("s", (F.col("cy") + F.col("s.dy")).alias("cy"), (F.col("cx") + F.col("s.dx")).alias("cx"), F.col("v").alias("vb"))
    m = a.join(moved, ["cx", "cy"]).groupBy("s").agg(F.avg(F.col("v") * F.col("vb")).alias("mean"))
    return m.orderBy(F.desc("mean"), "s.dy", "s.dx").limit(1).select("s.dy", "s.dx", "mean")


#: 3 x 3 kernels.
KERNELS = {"sobel_x": ((-1, 0, 1), (-2, 0, 2), (-1, 0, 1)), "sobel_y": ((-1, -2, -1), (0, 0, 0), (1, 2, 1)), "blur": ((1 / 9,) * 3,) * 3}


def convolve(cells: DataFrame, band: str, kernel: str) -> DataFrame:
    """cx, cy, value of a 3 x 3 kernel; cells outside the image count as 0. Each cell is sent to the
    cells it weighs on, and sums are combined before the shuffle."""
    k = KERNELS[kernel]
    moves = F.array(*[F.struct(F.lit(1 - j).alias("dx"), F.lit(1 - i).alias("dy"), F.lit(float(k[i][j])).alias("w")) for i in range(3) for j in range(3) if k[i][j]])
    sent = cells.select("cx", "cy", band, F.explode(moves).alias("m")).select((F.col("cx") + F.col("m.dx")).alias("cx"), (F.col("cy") + F.col("m.dy")).alias("cy"), (F.col(band) * F.col("m.w")).alias("v"))
    out = sent.groupBy("cx", "cy").agg(F.sum("v").alias("value"))
    return cells.select("cx", "cy").join(out, ["cx", "cy"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))


def not_empty(tiles: DataFrame) -> DataFrame:
    """Tiles (payload) with a byte other than 0."""
    return tiles.filter(F.hex("payload").rlike("[1-9A-F]"))
