"""Sharding by fixed virtual slots (native).

Every record hashes into one of SLOTS virtual slots, bytes are summed per slot, and a
versioned slot-to-shard map says where each slot lives. Rebalancing edits the map only.
Law: `bytes` (shard sizes nearly equal).

Defined results: null text counts 16 bytes and has the checksum of the empty text; a null
doc_id is hashed by its text instead; repeated rows are rows of their own; an empty table
gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pelagos.session import materialize, table

NAME = "op7_virtual_slots"
SLOTS, SHARDS, RECORD_BYTES = 4096, 40, 16


def records(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot of every document; the text goes."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        (F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce("text", F.lit("")))))), 1, 8), 16, 10).cast("long") % SLOTS).cast("int").alias("vslot"),
    )


def slot_totals(recs: DataFrame) -> DataFrame:
    """At most SLOTS rows, whatever the input."""
    return recs.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def slot_map(totals: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 1: the largest slot first, each to the least loaded shard.

    One row folds an array of at most SLOTS totals, so its size doesn't follow the input.
    """
    folded = totals.agg(F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("k"), "vslot", "bytes", "rows"))).alias("s")).selectExpr(
        "s",
        f"""aggregate(s, named_struct('loads', array_repeat(0L, {shards}), 'put', cast(array() as array<int>), 'at', 0),
            (acc, x) -> named_struct(
                'loads', transform(acc.loads, (l, i) -> if(i = acc.at, l + x.bytes, l)),
                'put', array_append(acc.put, acc.at),
                'at', cast(array_position(transform(acc.loads, (l, i) -> if(i = acc.at, l + x.bytes, l)),
                      array_min(transform(acc.loads, (l, i) -> if(i = acc.at, l + x.bytes, l)))) - 1 as int))).put as put""",
    )
    return folded.select(F.explode(F.arrays_zip("s", "put")).alias("z")).select(
        F.lit(1).alias("version"), F.col("z.s.vslot").alias("vslot"), F.col("z.put").alias("shard"), F.col("z.s.bytes").alias("bytes"), F.col("z.s.rows").alias("rows"))


def grow(placed: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, with shard number `shards` added: each old shard gives away
    its smallest slots while they fit into what it holds above the new mean. Other slots stay."""
    by_size = Window.partitionBy("shard").orderBy("bytes", "vslot")
    mean = placed.agg((F.sum("bytes") / (shards + 1)).alias("mean"))
    held = placed.withColumn("held", F.sum("bytes").over(Window.partitionBy("shard"))).withColumn("given", F.sum("bytes").over(by_size.rowsBetween(Window.unboundedPreceding, 0)))
    return held.join(F.broadcast(mean)).select(
        (F.col("version") + 1).alias("version"), "vslot", F.when(F.col("given") <= F.col("held") - F.col("mean"), F.lit(shards)).otherwise(F.col("shard")).alias("shard"), "bytes", "rows")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Rows in a shard are numbered slot by slot: a slot's offset comes from the map, the place
    inside it from a window over one of SLOTS even groups."""
    recs = records(docs)
    placed = materialize(slot_map(slot_totals(recs), shards), "slot-map")
    ahead = Window.partitionBy("shard").orderBy("vslot")
    offsets = placed.select("vslot", "shard", (F.sum("rows").over(ahead) - F.col("rows")).alias("offset"))
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    # the map has SLOTS rows at most
    return recs.withColumn("n", F.row_number().over(inside)).join(F.broadcast(offsets), "vslot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("n") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce([i::BIGINT, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
recs AS (SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) + {RECORD_BYTES} AS BIGINT) AS size,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: ('0x' || b)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32,
  CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))), 1, 8))::BIGINT % {SLOTS} AS INTEGER) AS vslot FROM documents, tab),
tot AS (SELECT vslot, CAST(sum(size) AS BIGINT) AS b, count(*) AS n FROM recs GROUP BY vslot),
seq AS (SELECT list({{'loads': []::BIGINT[], 'put': []::INTEGER[], 'b': b}} ORDER BY b DESC, vslot) AS s, list(vslot ORDER BY b DESC, vslot) AS v FROM tot),
fold AS (SELECT v, list_reduce(list_prepend({{'loads': list_transform(range({SHARDS}), lambda i: 0::BIGINT), 'put': []::INTEGER[], 'b': 0::BIGINT}}, s),
  lambda a, x: {{'loads': list_transform(a.loads, lambda l, i: CASE WHEN i = list_position(a.loads, list_min(a.loads)) THEN l + x.b ELSE l END),
     'put': list_append(a.put, CAST(list_position(a.loads, list_min(a.loads)) - 1 AS INTEGER)), 'b': 0::BIGINT}}).put AS p FROM seq),
placed AS (SELECT unnest(v) AS vslot, unnest(p) AS shard FROM fold)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY vslot, doc_id, text_crc32, size) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM recs JOIN placed USING (vslot)
"""
