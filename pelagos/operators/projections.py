"""Row projections that need more than one expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagos.functions import geo


def clean_metadata(df: DataFrame) -> DataFrame:
    """Missing columns and values become 0; confidence in [0, 1], sizes in [0, 1000], orientation
    modulo 360."""
    def col(c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)
    return df.withColumns({
        "confidence": F.least(F.greatest(col("confidence"), F.lit(0.0)), F.lit(1.0)), "length": F.least(F.greatest(col("length"), F.lit(0.0)), F.lit(1000.0)),
        "width": F.least(F.greatest(col("width"), F.lit(0.0)), F.lit(1000.0)), "orientation": F.pmod(col("orientation"), F.lit(360.0)), "metadata_source": F.lit("enhanced"),
    })


def heading_target(degrees: Column) -> Column:
    """16 weights: 8/14 at the bucket, 1/14 beside it near its edge (within 5 degrees), 2/14 at the
    opposite one and 1/14 beside that; later ones overwrite."""
    b = F.floor(degrees * 16 / 360).cast("int")
    near = F.abs(degrees - (b * 22.5 + 11.25)) > 6.25
    def at(i: Column, k: int) -> Column:
        return i == (b + k) % 16
    return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.round(F.when(at(i, 9) | at(i, 7), 1 / 14).when(at(i, 8), 2 / 14).when(near & (at(i, 1) | at(i, 15)), 1 / 14).when(i == b, 8 / 14).otherwise(0.0), 6))


def custom_target(properties: str) -> Column:
    """21 numbers from a label's JSON: length and width over 100, 16 heading weights, speed, and
    whether it isn't or is a fishing vessel (type 30)."""
    def num(k: str) -> Column:
        return F.get_json_object(properties, f"$.{k}").cast("double")
    fishing = F.coalesce(num("ShipAndCargoType") == 30, F.lit(False))
    return F.concat(F.array(num("Length") / 100, num("Width") / 100), heading_target(num("Heading")), F.array(num("Speed"), F.when(fishing, 0.0).otherwise(1.0), F.when(fishing, 1.0).otherwise(0.0)))


def regression_target(labels: DataFrame, order: str = "value") -> DataFrame:
    """window_id, target: the value of each window's first label, 0 without one."""
    return labels.groupBy("window_id").agg(F.coalesce(F.min_by("value", order), F.lit(0.0)).alias("target"))


#: Targets by task: box and point labels stay as they are (boxes by F21, M21).
LABEL_TARGETS = {"custom": custom_target, "regression": regression_target}


def catalog_of(name: str) -> Column:
    n = F.col(name)
    return F.when(n.rlike("^S1"), "sentinel1").when(n.rlike("^S2"), "sentinel2").otherwise("landsat")


def stamp_of(name: str) -> Column:
    """The 15-character part of a scene's name that holds its time; null where there is none."""
    return F.nullif(F.regexp_extract(name, r"(?:^|[_\-.])(\d{8}T\d{6})(?=$|[_\-.])", 1), F.lit(""))


def stamp_time(stamp: Column) -> Column:
    return F.try_to_timestamp(stamp, F.lit("yyyyMMdd'T'HHmmss")).cast("timestamp_ntz")


def rescale_boxes(df: DataFrame, offset: int, scale: float, most: int) -> DataFrame:
    """Boxes shifted, scaled and clamped to [0, most]; empty ones go."""
    out = df
    for axis in ("x", "y"):
        out = out.withColumn(axis + "1", F.greatest(F.floor((F.col(f"bbox_{axis}1") - offset) * scale), F.lit(0))).withColumn(axis + "2", F.least(F.floor((F.col(f"bbox_{axis}2") - offset) * scale), F.lit(most)))
    return out.filter("x2 > x1")


def demo_grid(spark: SparkSession, nx: int, ny: int) -> DataFrame:
    """A geolocation grid of nodes (cx, cy, lat), like a product's annotation."""
    return spark.range(nx * ny).select((F.col("id") % nx).alias("cx"), F.expr(f"id div {nx}").alias("cy")).withColumn("lat", 36.0 + 0.01 * F.col("cy") + 0.001 * F.col("cx") * F.col("cx"))


def interpolate_on_grid(points: DataFrame, grid: DataFrame, step: int) -> DataFrame:
    """Bilinear interpolation between the four nodes about a pixel: four equi joins become one,
    as each node goes to the four cells it bounds."""
    corners = grid.select("cx", "cy", "lat", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])).alias("c"))
    cells = corners.groupBy((F.col("cx") - F.col("c.i")).alias("gx"), (F.col("cy") - F.col("c.j")).alias("gy")).agg(*[F.max(F.when((F.col("c.i") == i) & (F.col("c.j") == j), F.col("lat"))).alias(f"q{i}{j}") for i in (0, 1) for j in (0, 1)])
    p = points.withColumn("gx", F.floor(F.col("preprocess_column") / step)).withColumn("gy", F.floor(F.col("preprocess_row") / step))
    fx, fy = F.col("preprocess_column") / step - F.col("gx"), F.col("preprocess_row") / step - F.col("gy")
    return p.withColumn("_x", fx).withColumn("_y", fy).join(cells, ["gx", "gy"]).withColumn("lat", geo.bilinear("_x", "_y", "q00", "q10", "q01", "q11")).drop("_x", "_y")
