"""Classes, counts, metrics and analytic helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagos.functions import scoring
from pelagos.functions.geo import iou
from pelagos.operators.spatial import box_pairs, quantiles
from pelagos.session import materialize


def size_class(length: str) -> Column:
    c = F.col(length)
    return F.when(c > 100, "Large").when(c >= 50, "Medium").when(c.isNull(), "Unknown").otherwise("Small")


def speed_class(sog: str) -> Column:
    c = F.col(sog)
    return F.when(c <= 0.5, "stationary").when(c <= 2, "very_slow").when(c <= 5, "slow").when(c > 5, "moving")


def confidence_class(confidence: str) -> Column:
    c = F.col(confidence)
    return F.when(c >= 0.8, "high").when(c >= 0.6, "medium").when(c >= 0.4, "low").otherwise("very_low")


def value_counts(df: DataFrame, col: str, head: int | None = None) -> DataFrame:
    out = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)
    return out.limit(head) if head else out


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur more than once. Counts are combined before the shuffle and joined
    back, so a frequent key isn't gathered."""
    many = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return df.join(many, keys)


def threshold_sweep(df: DataFrame, thresholds: list[float]) -> DataFrame:
    """Confusion counts and F1 for every threshold, in one pass over (score, is_gt)."""
    parts = []
    for i, t in enumerate(thresholds):
        over = F.col("score") > t
        parts += [F.count_if(over & (F.col("is_gt") == 1)).alias(f"tp{i}"), F.count_if(over & (F.col("is_gt") == 0)).alias(f"fp{i}"), F.count_if(~over & (F.col("is_gt") == 1)).alias(f"fn{i}"), F.count_if(~over & (F.col("is_gt") == 0)).alias(f"tn{i}")]
    once = df.agg(*parts)
    rows = F.array(*[F.struct(F.lit(t).alias("thr"), *[F.col(f"{k}{i}").alias(k) for k in ("tp", "fp", "fn", "tn")]) for i, t in enumerate(thresholds)])
    out = once.select(F.explode(rows).alias("r")).select("r.*")
    f1, p, r = scoring.f1("tp", "fp", "fn")
    return out.withColumn("f1", f1).withColumn("precision", p).withColumn("recall", r)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The first threshold of the largest F1."""
    return sweep.agg(F.max_by("thr", F.struct("f1", -F.col("thr"))).alias("thr"), F.max("f1").alias("f1"))


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int, name: str | None = None) -> DataFrame:
    """Counts of equal bins 1 .. bins; the last one includes its right edge."""
    c = F.col(col)
    b = F.when(c == hi, bins).otherwise(F.floor((c - lo) / ((hi - lo) / bins)) + 1)
    return df.filter(c.between(lo, hi)).groupBy(F.lit(name or col).alias("what"), b.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def error_metrics(df: DataFrame) -> DataFrame:
    """(p, y, is_gt): absolute and squared error, cross entropy and accuracy at 0.5."""
    e, hit = F.col("p") - F.col("y"), F.when(F.col("is_gt") == 1, F.col("p")).otherwise(1 - F.col("p"))
    return df.agg(F.round(F.avg(F.abs(e)), 6).alias("mae"), F.round(F.avg(e * e), 6).alias("mse"), F.round(-F.avg(e * e), 6).alias("mse_score"),
                  F.round(F.avg(-F.log(F.greatest(hit, F.lit(1e-6)))), 6).alias("cross_entropy"), F.round(F.avg(F.when((F.col("p") > 0.5) == (F.col("is_gt") == 1), 1.0).otherwise(0.0)), 6).alias("accuracy"))


def percent_errors(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Capped ratio score, error over the truth, and the score of an angle."""
    t, p = F.col(truth), F.col(pred)
    d = F.abs(t - p)
    return df.agg(F.round(1 - F.avg(F.least(d / F.greatest(t, p), F.lit(1.0))), 6).alias("size_score"), F.round(F.avg(d / t), 6).alias("normalised"), F.round(1 - F.avg(F.least(F.least(d, 360 - d), F.lit(180.0))) / 180, 6).alias("degree_score"))


def average_precision(boxes: DataFrame, threshold: float, side: float) -> DataFrame:
    """AP at an IoU: a prediction, best first, is right if it is the best of its truth. Boxes are
    squares about (x, y). Ranks come from a sort in many tasks: each sorted partition counts on
    from the sums of those before."""
    b = boxes.selectExpr("id", "scene_id", "is_gt", "score", *[f"{c} {s} {side / 2} AS {n}" for n, c, s in (("bbox_x1", "x", "-"), ("bbox_y1", "y", "-"), ("bbox_x2", "x", "+"), ("bbox_y2", "y", "+"))])
    box = ("bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2")
    both = box_pairs(b, "id", (F.col("is_gt_a") != F.col("is_gt_b")) & (iou(*[c + "_a" for c in box], *[c + "_b" for c in box]) >= threshold), also=("scene_id",))
    one = F.col("is_gt_a") == 1
    pair = both.select(F.when(one, F.col("id_a")).otherwise(F.col("id_b")).alias("gt"), F.when(one, F.col("id_b")).otherwise(F.col("id_a")).alias("id"), F.when(one, F.col("score_b")).otherwise(F.col("score_a")).alias("s"))
    right = pair.groupBy("gt").agg(F.min_by("id", F.struct(-F.col("s"), "id")).alias("id")).select("id").distinct().withColumn("hit", F.lit(1))
    ranked = b.filter("is_gt = 0").join(right, "id", "left").select("score", "id", F.coalesce("hit", F.lit(0)).alias("hit"))
    order = materialize(ranked.orderBy(F.desc("score"), "id").select("hit", F.monotonically_increasing_id().alias("m")), "ranked").withColumn("p", F.shiftright("m", 33))
    ahead = Window.orderBy("p")  # one row for each partition of the sort
    sums = order.groupBy("p").agg(F.count(F.lit(1)).alias("k"), F.sum("hit").alias("h"))
    sums = sums.select("p", (F.sum("k").over(ahead) - F.col("k")).alias("n0"), (F.sum("h").over(ahead) - F.col("h")).alias("tp0"))
    w = Window.partitionBy("p").orderBy("m")
    run = order.withColumn("tp1", F.sum("hit").over(w)).withColumn("n1", F.row_number().over(w)).filter("hit = 1").join(F.broadcast(sums), "p")
    run = run.select((F.col("tp0") + F.col("tp1")).alias("tp"), (F.col("n0") + F.col("n1")).alias("n"))
    total = b.filter("is_gt = 1").agg(F.count(F.lit(1)).alias("total"))
    return run.agg(F.sum(F.col("tp") / F.col("n")).alias("s")).join(F.broadcast(total)).select(F.round(F.coalesce("s", F.lit(0.0)) / F.col("total"), 6).alias("average_precision"))


def mask_statistics(cells: DataFrame) -> DataFrame:
    p = quantiles(cells.filter("vv > 0"), "vv", [0.01, 0.25, 0.99])
    return cells.agg(*[F.lit(v).cast("double").alias(n) for n, v in zip(("p1", "p25", "p99"), p)], F.round(100.0 * F.avg(F.when(F.col("vv") == 0, 1.0).otherwise(0.0)), 6).alias("zero_pct"), F.round(100.0 * F.avg("water"), 6).alias("water_pct"))


def sampling_weights(df: DataFrame, foreground: str, fraction: float) -> DataFrame:
    n = df.agg(F.sum(foreground).alias("_fg"), (F.count(F.lit(1)) - F.sum(foreground)).alias("_bg"))
    return df.join(F.broadcast(n)).withColumn("weight", F.when(F.col(foreground) == 1, 1.0).otherwise(F.round(fraction * F.col("_fg") / F.col("_bg"), 9))).drop("_fg", "_bg")


def min_max(df: DataFrame, col: str, eps: float = 1e-8) -> DataFrame:
    """Normalised by the table's range: a one-row aggregate instead of a window over all rows."""
    r = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    return df.join(F.broadcast(r)).withColumn(col + "_norm", (F.col(col) - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + eps)).drop("_lo", "_hi")


def every_kth(df: DataFrame, col: str, most: int) -> DataFrame:
    """About `most` of the sorted distinct values: every (n div most)-th; all if there are fewer.
    The values are minutes of one time window, so their number is bounded by its length."""
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    k = df.withColumn("_k", F.row_number().over(Window.orderBy(col)) - 1).join(F.broadcast(n))
    return k.filter((F.col("_n") <= most) | (F.expr(f"_k % greatest(_n div {most}, 1)") == 0)).select(col)


def distance_batches(df: DataFrame, group: str, far: float) -> DataFrame:
    """Number of the batch in the order of (row_px, col_px): a step over `far` starts a new one."""
    w = Window.partitionBy(group).orderBy("row_px", "col_px", "id")
    step = F.sqrt(F.pow(F.col("row_px") - F.lag("row_px").over(w), 2) + F.pow(F.col("col_px") - F.lag("col_px").over(w), 2))
    return df.withColumn("_s", F.when(step > far, 1).otherwise(0)).withColumn("batch", F.sum("_s").over(w)).drop("_s")
