import zlib
from collections import defaultdict

from pelagos.llm import op7_sharding as op


def test_sizes_near_equal_and_slots_gapless(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    rows = op.query(spark, "/root/testdata/sf0.01").collect()
    size, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sorted(size) == list(range(40)) and len(rows) == len(docs)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) - min(size.values()) < 0.02 * max(size.values())


def test_greedy_map(spark):
    totals = spark.createDataFrame([(i, (i * 7919) % 1000 + 1, 1) for i in range(300)], "vslot int, bytes long, rows long")
    got = {r.vslot: r.shard for r in op.slot_map(totals, 7).collect()}
    loads, want = [0] * 7, {}
    for b, v in sorted((-((i * 7919) % 1000 + 1), i) for i in range(300)):
        k = loads.index(min(loads))
        want[v] = k
        loads[k] -= b
    assert got == want


def test_rebalancing_edits_the_map(spark):
    totals = spark.createDataFrame([(i, 100 + i % 9, 1) for i in range(4000)], "vslot int, bytes long, rows long")
    first = op.slot_map(totals, 8).cache()
    second = op.grow(first, 8).cache()
    a, b = ({r.vslot: r.shard for r in df.collect()} for df in (first, second))
    assert {b[v] for v in a if a[v] != b[v]} == {8} and {r.version for r in second.collect()} == {2}
    load = defaultdict(int)
    for r in second.collect():
        load[r.shard] += r.bytes
    assert max(load.values()) - min(load.values()) < 0.03 * max(load.values())


def test_edge_cases(docs, spark):
    assert op.shard(docs([])).count() == 0
    rows = op.shard(docs([(None, None), (1, "é"), (1, "é"), (2, "x" * 100_000)], extra=True)).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == [("1", 18, zlib.crc32("é".encode()))] * 2 + [("2", 100_016, zlib.crc32(b"x" * 100_000)), ("None", 16, 0)]


def test_null_ids_are_spread(docs, words):
    rows = op.shard(docs([(None, words(20, i)) for i in range(2000)] + [(i, words(20, i)) for i in range(500)])).collect()
    load = [sum(r.size for r in rows if r.shard == k) for k in range(op.SHARDS)]
    assert len(rows) == 2500 and max(load) < 1.1 * sum(load) / op.SHARDS
