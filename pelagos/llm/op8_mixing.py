"""Mixing sources to target weights by capped water-filling (native).

Sources in code point order, null last, weigh WEIGHTS in turn and share all words. A source
takes at most EPOCHS times its words; what is cut off goes to the others by weight until no
source is above its cap. A source's target is then whole repetitions of every document and
a fraction: documents in the order of a seeded hash are taken once more until the target is
met, the last of them in part.

Defined results: null or blank text has size 0 and is taken 0 words; a null source is a
source of its own; a null doc_id is hashed by its text; repeated rows are rows of their own; an empty table gives no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pelagos.llm.names import free_name
from pelagos.session import materialize, table

NAME = "op8_water_filling"
WEIGHTS, EPOCHS, SEED, BUCKETS = (5, 2, 1), 3, 8, 4096


def numbered(sources: DataFrame) -> DataFrame:
    """sources with rank 0.. in code point order, null last, from a sort in many tasks: the
    count of each sorted partition gives the next one's start."""
    order = materialize(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("m", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("m", 33)
    starts = order.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).select("p", (F.sum("n").over(Window.orderBy("p")) - F.col("n")).alias("start"))
    # one row for each partition of the sort
    return order.withColumn("p", part).join(F.broadcast(starts), "p").withColumn("rank", F.col("start") + F.col("m").bitwiseAND((1 << 33) - 1)).drop("m", "p", "start")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS, share: float = 1.0) -> DataFrame:
    """source, source_size -> and target. Each round is one aggregate over the sources."""
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = materialize(numbered(sizes).select("source", "source_size", weight.alias("w"), (F.col("source_size") * epochs).alias("cap")), "mix")
    level = None
    while True:
        free = F.lit(True) if level is None else F.col("cap") >= F.col("w") * F.lit(level)
        r = s.agg(F.sum("source_size").alias("total"), F.coalesce(F.sum(F.when(~free, F.col("cap"))), F.lit(0)).alias("capped"), F.sum(F.when(free, F.col("w"))).alias("free")).first()
        if not r.free:  # no source at all, or each at its cap
            return s.select("source", "source_size", F.col("cap").cast("double").alias("target"))
        new = ((r.total if share == 1.0 else r.total * share) - r.capped) / float(r.free)
        if new == level:
            return s.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("w") * F.lit(new)).alias("target"))
        level = new


def mix(docs: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source, source_size, target, taken of every document."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce("text", F.lit("")))))))
    base = materialize(docs.select(
        h.alias("h"),
        F.col("doc_id").cast("long").alias("doc_id"), "source",
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size")), "words")
    base = base.withColumn("bucket", (F.conv(F.substring("h", 1, 8), 16, 10).cast("long") % BUCKETS).cast("int"))
    per = materialize(base.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "buckets")
    goal = targets(per.groupBy("source").agg(F.sum("words").alias("source_size")), weights, epochs)
    goal = goal.withColumn("want", F.floor(F.col("target") + 0.5)).withColumn("whole", F.when(F.col("source_size") > 0, F.expr("want div source_size")).otherwise(0)).withColumn("rest", F.col("want") - F.col("whole") * F.col("source_size"))
    # at most BUCKETS rows of a source meet in the window
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cut = (per.withColumn("upto", F.sum("words").over(ahead)).withColumnRenamed("source", "s").withColumnRenamed("bucket", "b")
           .join(goal.withColumnRenamed("source", "gs"), F.col("s").eqNullSafe(F.col("gs"))).drop("gs")
           .withColumn("left", F.col("rest") - (F.col("upto") - F.col("words"))))
    rows = base.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    split = (F.col("left") > 0) & (F.col("left") < F.col("words"))
    out = ["doc_id", "size", "source", "source_size", "target"]
    full = rows.filter(~split).select(*out, (F.col("whole") * F.col("size") + F.when(F.col("left") > 0, F.col("size")).otherwise(0)).alias("taken"))
    # one bucket of a source at most is cut
    before = F.sum("size").over(Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    part = rows.filter(split).withColumn("before", before).select(
        *out, (F.col("whole") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("before")))).alias("taken"))
    return full.unionByName(part)


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """docs with each row as often as the mix takes it, to the nearest whole number. Rows of one
    doc_id (null is one) are taken as often as the one of them that is taken most."""
    key, n = free_name(docs, "id"), free_name(docs, "n")
    times = mix(docs, weights, epochs, seed).filter("taken > 0").withColumn("t", F.expr("(taken + size div 2) div size"))
    times = times.groupBy(F.col("doc_id").alias(key)).agg(F.max("t").cast("int").alias(n)).filter(F.col(n) > 0)
    return docs.join(times, docs["doc_id"].eqNullSafe(times[key])).withColumn(n, F.explode(F.sequence(F.lit(1), n))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = f"""
WITH base AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
  md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))) AS h FROM documents),
b2 AS (SELECT *, CAST(('0x' || substr(h, 1, 8))::BIGINT % {BUCKETS} AS INTEGER) AS bucket FROM base),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM b2 GROUP BY source),
w AS (SELECT *, [{', '.join(map(str, WEIGHTS))}][rk % {len(WEIGHTS)} + 1] AS w, source_size * {EPOCHS} AS cap FROM src),
o AS (SELECT *, sum(cap) OVER k - cap AS capped, sum(w) OVER () - sum(w) OVER k + w AS free, sum(source_size) OVER () AS total FROM w WINDOW k AS (ORDER BY cap / CAST(w AS DOUBLE), rk)),
l AS (SELECT max(CAST(total - capped AS DOUBLE) / CAST(free AS DOUBLE)) FILTER (WHERE CAST(total - capped AS DOUBLE) / CAST(free AS DOUBLE) * w <= cap) AS lv FROM o),
g AS (SELECT source, source_size, CASE WHEN lv IS NULL THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), w * lv) END AS target FROM w, l),
g2 AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS want FROM g),
r AS (SELECT b2.doc_id, b2.size, g2.source_size, target, want, CAST(coalesce(sum(size) OVER (PARTITION BY b2.source ORDER BY bucket, h, b2.doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cum
  FROM b2 JOIN g2 ON b2.source IS NOT DISTINCT FROM g2.source)
SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE want // source_size * size + greatest(0, least(size, want % source_size - cum)) END AS taken FROM r
"""
