"""Names of helper columns that no column of a table has, and keys of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagos.session import materialize

NULL = -(1 << 63)


def free_name(df: DataFrame, stem: str) -> str:
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def with_key(docs: DataFrame, name: str) -> DataFrame:
    """docs with a column `name`: longs in the order of doc_id (null first) that tell different
    texts apart. doc_id itself where each has one text; else the place in a sort of the pairs."""
    okey, text = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL)), F.xxhash64(F.coalesce("text", F.lit("")))
    pairs = docs.select(okey.alias("k"), text.alias("t"))
    if pairs.groupBy("k").agg(F.min("t").alias("a"), F.max("t").alias("b")).filter("a <> b").isEmpty():
        return docs.withColumn(name, okey)
    order = materialize(pairs.distinct().orderBy("k", "t").withColumn("m", F.monotonically_increasing_id()), "keys")
    k, t = free_name(docs, "k"), free_name(docs, "t")
    order = order.select(F.col("k").alias(k), F.col("t").alias(t), F.col("m").alias(name))
    return docs.withColumn(k, okey).withColumn(t, text).join(order, [k, t]).drop(k, t)
