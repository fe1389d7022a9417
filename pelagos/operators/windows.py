"""Window plans: rows of (row, col[, row_end, col_end]) from sequences, one job without data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Strategies by ground size, and by megapixels.
GROUND = {
    "small_vessels": {"ground_m": 5120, "overlap_m": 1024, "confidence": 0.4, "nms": 0.25}, "medium_vessels": {"ground_m": 10240, "overlap_m": 1536, "confidence": 0.3, "nms": 0.3},
    "large_vessels": {"ground_m": 20480, "overlap_m": 2048, "confidence": 0.25, "nms": 0.4}, "adaptive": {"ground_m": 10240, "overlap_m": 1536, "confidence": 0.3, "nms": 0.3},
}
MEGAPIXELS = (
    (400, "ocean_deep", 800, 50, 0.5, 0.25), (200, "ocean_coastal", 1536, 100, 0.4, 0.3), (100, "harbor_detail", 1024, 150, 0.3, 0.35), (0, "ultra_detail", 768, 200, 0.25, 0.4),
)


def _steps(spark: SparkSession, name: str, last: int, step: int) -> DataFrame:
    """0, step, .. up to last; none if last is negative."""
    if last < 0:
        return spark.range(0).select(F.col("id").alias(name))
    return spark.range(0, last + 1, step).select(F.col("id").alias(name))


def sliding(spark: SparkSession, height: int, width: int, size: int, step: int) -> DataFrame:
    return _steps(spark, "row", height - size, step).crossJoin(_steps(spark, "col", width - size, step))


def sliding_with_edge(spark: SparkSession, height: int, width: int, size: int, overlap: int) -> DataFrame:
    """A single corner window each for a missing last row and last column."""
    step = size - overlap
    out = sliding(spark, height, width, size, step)
    if (height - size) % step:
        out = out.union(spark.range(1).select(F.lit(height - size).cast("long"), F.lit(0).cast("long")))
    # the column is missing unless it is a multiple, or the corner just added starts there
    if (width - size) % step and not (width == size):
        out = out.union(spark.range(1).select(F.lit(0).cast("long"), F.lit(width - size).cast("long")))
    return out


def offsets(spark: SparkSession, name: str, whole: int, size: int, overlap: float) -> DataFrame:
    """Clamped offsets and the final one; overlap in pixels, or a ratio below 1."""
    ov = int(overlap) if overlap >= 1 else int(size * overlap)
    step = max(1, size - ov)
    n = max(1, (whole - size) // step + 1)
    return spark.range(n).select(F.least(F.col("id") * step, F.lit(whole - size)).alias(name)).union(spark.range(1).select(F.lit(whole - size).cast("long"))).distinct()


def clamped(spark: SparkSession, height: int, width: int, size: int, overlap: float) -> DataFrame:
    return offsets(spark, "row", height, size, overlap).crossJoin(offsets(spark, "col", width, size, overlap))


def metre_windows(spark: SparkSession, height: int, width: int, spacing: float, strategy: str = "medium_vessels", most: int | None = None) -> DataFrame:
    """Windows of a ground size; right and bottom edge windows end at the image's end."""
    g = GROUND[strategy]
    size, ov = int(g["ground_m"] / spacing), int(g["overlap_m"] / spacing)
    step = max(1, size - ov)
    main = sliding(spark, height, width, size, step).select("row", "col", (F.col("row") + size).alias("row_end"), (F.col("col") + size).alias("col_end"))
    if most:
        main = main.orderBy("row", "col").limit(most)
    half = max(1, size // 2)
    right = _steps(spark, "row", height - size, half).select("row", F.lit(width - size).cast("long").alias("col"))
    bottom = _steps(spark, "col", width - size, half).select(F.lit(height - size).cast("long").alias("row"), "col")
    edge = right.union(bottom).distinct() if height >= size and width >= size else right.union(bottom)
    edge = edge.join(main.select("row", "col"), ["row", "col"], "left_anti").select("row", "col", F.lit(height).cast("long").alias("row_end"), F.lit(width).cast("long").alias("col_end"))
    return main.union(edge)


def padded(spark: SparkSession, height: int, width: int, size: int, step: int, padding: int) -> DataFrame:
    inner = sliding(spark, height - 2 * padding, width - 2 * padding, size, step)
    return inner.select((F.col("row") + padding).alias("row"), (F.col("col") + padding).alias("col")).filter((F.col("row") + size <= height) & (F.col("col") + size <= width))


def chunks(spark: SparkSession, height: int, width: int, ch: int, cw: int, overlap: int) -> DataFrame:
    """Overlapping chunks up to the end; those past it are padded with zeros."""
    r, c = _steps(spark, "row", height - 1, ch - overlap), _steps(spark, "col", width - 1, cw - overlap)
    return r.crossJoin(c).select("row", "col", F.greatest(F.col("row") + ch - height, F.lit(0)).alias("pad_rows"), F.greatest(F.col("col") + cw - width, F.lit(0)).alias("pad_cols"))


def megapixel_strategy(pixels: Column) -> Column:
    out = None
    for mp, name, *_ in MEGAPIXELS:
        c = pixels > mp * 1_000_000
        out = F.when(c, name) if out is None else (out.when(c, name) if mp else out.otherwise(name))
    return out


def vessel_windows(categories: DataFrame) -> DataFrame:
    """(category, max_m, resolution) -> window size (a power of two in [256, 1024]), overlap ratio
    in [0.1, 0.7], and the suppression threshold in pixels."""
    px = F.col("max_m") / F.col("resolution")
    size = F.greatest(F.least(F.pow(F.lit(2.0), F.ceil(F.log2(px * 2))), F.lit(1024.0)), F.lit(256.0))
    return categories.select("category", size.cast("int").alias("window_size"), F.greatest(F.least(px * 0.5 / size, F.lit(0.7)), F.lit(0.1)).alias("overlap_ratio"), (px * 1.2).alias("nms_px"))


def region_windows(regions: DataFrame, height: int, width: int) -> DataFrame:
    """(region, kind, area, density, edge, x, y, w, h) -> windows (row, col, size) over each region,
    sized and overlapped by its kind, density, distance from the edge and area."""
    base = F.when(F.col("kind") == "large", 2048).when(F.col("kind") == "medium", 1024).otherwise(512)
    factor = (1 + (F.col("density") - 0.5) * 0.4) * (1 + F.least(F.col("edge") / 200, F.lit(0.3))) * (1 + F.least((F.col("area") - 1_000_000) / 10_000_000, F.lit(0.2)))
    size = F.greatest(F.lit(256), F.least((base * factor).cast("int"), F.lit(4096)))
    ratio = F.least(F.when(F.col("kind") == "large", 0.05).when(F.col("kind") == "medium", 0.15).otherwise(0.25) + ((1 - F.col("density")) + (1 - F.least(F.col("edge") / 100, F.lit(1.0)))) * 0.1, F.lit(0.4))
    r = regions.withColumn("size", size).withColumn("ov", (F.col("size") * ratio).cast("int"))

    def run(start: str, length: str, whole: int) -> str:
        lo, hi = f"greatest(0, {start} - ov)", f"least({whole} - size, {start} + {length} + ov)"
        return f"if({hi} >= {lo}, sequence(cast({lo} as long), cast({hi} as long), cast(size - ov as long)), cast(array() as array<bigint>))"

    return r.withColumn("row", F.explode(F.expr(run("y", "h", height)))).withColumn("col", F.explode(F.expr(run("x", "w", width)))).select("region", "row", "col", "size")


def region_priority() -> Column:
    return F.least(F.col("area") / 9_000_000, F.lit(1.0)) * 0.4 + F.col("density") * 0.4 + F.least(F.col("edge") / 100, F.lit(1.0)) * 0.2


def override_parameters(confidence: float | None, nms: float | None, preset: dict, sar: bool = True) -> dict:
    """A preset's window, overlap and suppression always hold; its confidence only where the
    user's is more than 0.05 below; a fractional suppression threshold is refused for SAR."""
    out = {"window_size": preset["window_size"], "overlap": preset["overlap"]}
    out["nms"] = nms if sar and preset["nms"] < 1 else preset["nms"]
    out["confidence"] = preset["confidence"] if confidence is None or confidence < preset["confidence"] - 0.05 else confidence
    return out


def channel_layout(bands: Column, catalog: Column) -> Column:
    """Names of the channels that a model is given."""
    return (F.when((catalog == "sentinel1") & (bands >= 6), F.array(*map(F.lit, ("vh", "vv", "vh_overlap1", "vv_overlap1", "vh_overlap2", "vv_overlap2"))))
            .when((catalog == "sentinel1") & (bands >= 2), F.array(*map(F.lit, ("vh", "vv")))).when(catalog == "sentinel1", F.array(F.lit("vv"))).otherwise(F.transform(F.sequence(F.lit(1), bands), lambda i: F.concat(F.lit("band"), i.cast("string")))))
