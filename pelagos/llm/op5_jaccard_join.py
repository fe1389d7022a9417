"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

1. Shingles are counted over all documents, hashed and combined in map tasks, in even buckets,
   by the upper bits of their hashes (40 below the bucket's; shingles that agree there count
   together, which is one order for all documents still). Those of at least RARE documents go
   into a table of at most TABLE entries (RARE doubles until they fit), which is broadcast; all
   others count as equally rare.
2. A document's shingles are ordered rarest first (count, then hash). Documents with the same
   set are one class. The first n - ceil(t n) + 1 shingles of a class are its prefix; sets that
   link share one of them.
3. Classes meet on a prefix shingle. Length and positional filters are part of the join; the
   suffix filter compares the counts of shingles in 16 hash ranges, a lower bound of the
   symmetric difference. A pair left over is verified once, on the whole sets of both texts,
   which travel compressed.
4. A group of near copies isn't spelt out into pairs: first each class meets LEADERS others
   of its block and length, and the links found give components; then only pairs of different
   components meet. A link left out lies inside a component, which it
   couldn't change. links() leaves none out and gives them between classes.

Shingles are compared as 64-bit hashes. Defined results: text that is null or without words
has no shingle and is its own component; a null doc_id sorts before all others and its
component is null; rows of one doc_id are one node; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagos.llm import bytehash as bh
from pelagos.llm.names import free_name
from pelagos.operators.graph import connected_components
from pelagos.session import cut, keep, long_rows, materialize, release, table

NAME = "op5_prefix_filter"
RARE, TABLE, PER_BUCKET, SMALL, LEADERS, LOW, SLICE = 8, 2_000_000, 1 << 20, 1_000_000, 4, 5, 4 << 20
NULL = -(1 << 63)


@dataclass(frozen=True)
class Rule:
    """Shingles of `words` words; sets link at a Jaccard similarity of num / den or more."""
    words: int = 3
    num: int = 90
    den: int = 100

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - -(-self.num * n // self.den) + 1


def shingles(raws: list[bytes], words: int):
    """(number of the text, hash) of the distinct shingles of each text, sorted by both."""
    docs, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for first, b, starts in bh.chunks(raws):
        b = bh.lower(b)
        start, end = bh.words(b)
        if not len(start):
            continue
        w = bh.spans(bh.sums(b), start, end)
        doc = np.searchsorted(starts, start, side="right") - 1
        size = np.bincount(doc, minlength=len(starts) - 1)
        begin = np.cumsum(size) - size
        left = size[doc] - (np.arange(len(w)) - begin[doc])  # words from here to the end
        with np.errstate(over="ignore"):
            h = np.full(len(w), words, np.uint64)
            padded = np.concatenate([w, np.zeros(words, np.uint64)])
            for i in range(words):  # past the end of a short text nothing is added
                h = np.where(left > i, bh.mix(h * np.uint64(31) + padded[i:i + len(w)]), h)
        use = (left >= words) | (left == size[doc]) & (size[doc] < words)
        d, h = doc[use] + first, h[use]
        order = np.lexsort((h, d))
        d, h = d[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        docs.append(d[new])
        hashes.append(h[new])
    return np.concatenate(docs), np.concatenate(hashes)


def _raws(column) -> list[bytes]:
    return [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in column]


@dataclass(frozen=True)
class Counts:
    """Counts of common shingles, sorted by the upper bits of their hashes: TABLE entries at most."""
    bits: int
    upper: np.ndarray
    n: np.ndarray

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.upper):
            return np.zeros(len(h), np.uint32)
        x = h >> np.uint64(64 - self.bits)
        i = np.minimum(np.searchsorted(self.upper, x), len(self.upper) - 1)
        return np.where(self.upper[i] == x, self.n[i], 0).astype(np.uint32)


def _low(x: np.ndarray) -> bytes:
    """The low LOW bytes of each number."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LOW].tobytes()


def _wide(raws: list[bytes]) -> np.ndarray:
    b = np.frombuffer(b"".join(raws), np.uint8).reshape(-1, LOW)
    return np.concatenate([b, np.zeros((len(b), 8 - LOW), np.uint8)], 1).view("<u8").reshape(-1)


def common(docs: DataFrame, rule: Rule) -> Counts:
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(8, min(64 - 8 * LOW, (total // 6 // PER_BUCKET).bit_length()))
    low = np.uint64(8 * LOW)

    def count(batches):
        for batch in (whole.slice(at, 4000) for whole in batches for at in range(0, whole.num_rows, 4000)):
            _, h = shingles(_raws(batch.column(0)), rule.words)
            h, n = np.unique(h >> np.uint64(64 - bits - 8 * LOW), return_counts=True)
            bucket = (h >> low).astype(np.int64)
            cut = np.flatnonzero(np.diff(bucket)) + 1
            lone = [(int(k[0]), _low(x[c == 1]), _low(x[c > 1]), c[c > 1].astype("<u4").tobytes()) for k, x, c in zip(np.split(bucket, cut), np.split(h, cut), np.split(n, cut)) if len(x)]
            if lone:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lone), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["bucket", "lone", "more", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        lone, more = (_wide(rows.column(c).to_pylist()) for c in ("lone", "more"))
        counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), "<u4")
        h, inv = np.unique(np.concatenate([lone, more]), return_inverse=True)
        n = np.bincount(inv, np.concatenate([np.ones(len(lone)), counts]), len(h)).astype(np.int64)
        keep_ = n >= RARE
        upper = np.uint64(rows.column("bucket")[0].as_py()) << low | h[keep_]
        return pa.table({"h": upper.view(np.int64), "n": n[keep_]})

    counted = materialize(docs.select("text").mapInArrow(bh.lean(count), "bucket int, lone binary, more binary, counts binary").groupBy("bucket").applyInArrow(add, "h long, n long"), "counts")
    sizes = sorted((r.k, r.m) for r in counted.groupBy(F.floor(F.log2("n")).alias("k")).agg(F.count(F.lit(1)).alias("m")).collect())
    least = RARE
    while sum(m for k, m in sizes if 1 << k >= least) > TABLE:
        least *= 2
    rows = counted.filter(F.col("n") >= least).toArrow()
    release(counted)
    h, n = rows.column("h").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    order = np.argsort(h)
    return Counts(bits + 8 * LOW, h[order], n[order].astype(np.uint32))


def signatures(docs: DataFrame, rule: Rule, known: Counts) -> DataFrame:
    """okey, n, two hashes of the set, the prefix (rarest first), and counts of 16 hash ranges."""
    held = docs.sparkSession.sparkContext.broadcast(known)

    def task(batches):
        counts = held.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                m = batch.num_rows
                d, h = shingles(_raws(batch.column(1)), rule.words)
                df = counts.of(h)
                n = np.bincount(d, minlength=m)
                begin = np.cumsum(n) - n
                with np.errstate(over="ignore"):
                    sig = [np.concatenate([[0], np.cumsum(x, dtype=np.uint64)]).astype(np.uint64) for x in (bh.mix(h), bh.mix(h ^ np.uint64(0x5DEECE66D)))]
                    sig = [bh.mix(s[begin + n] - s[begin]) for s in sig]
                part = np.minimum(np.bincount(d * 16 + (h >> np.uint64(60)).astype(np.int64), minlength=m * 16), 127).reshape(m, 16).astype(np.int64)
                hist = [(part[:, j:j + 8] << (8 * np.arange(8))).sum(1) for j in (0, 8)]
                order = np.lexsort((h, df, d))
                take = np.where(n > 0, rule.prefix(n), 0)
                pick = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take) + np.repeat(begin, take)
                offsets = np.concatenate([[0], np.cumsum(take)]).astype(np.int32)
                prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(h[order][pick].view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *[pa.array(s.view(np.int64)) for s in sig], *[pa.array(x) for x in hist], prefix], names=["okey", "n", "s1", "s2", "h1", "h2", "prefix"])

    return docs.mapInArrow(bh.lean(task), "okey long, n long, s1 long, s2 long, h1 long, h2 long, prefix array<long>")


def _far(x: str, y: str) -> str:
    """Sum of the differences of eight counts in two longs: at most the symmetric difference."""
    return " + ".join(f"abs((shiftright({x}, {8 * i}) & 127) - (shiftright({y}, {8 * i}) & 127))" for i in range(8))


def _survivors(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) that pass the suffix filter."""
    own = classes.select("rep", "n", "h1", "h2")
    joined = (pairs.join(own.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("h1").alias("a1"), F.col("h2").alias("a2")), "a")
              .join(own.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("h1").alias("b1"), F.col("h2").alias("b2")), "b"))
    most = f"na + nb - 2 * {_alpha(rule, 'na', 'nb')}"
    return joined.filter(f"({_far('a1', 'b1')} + {_far('a2', 'b2')}) <= {most}").select("a", "b")


def _stars(rows: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) of each class with LEADERS others of its block and length class that pass the
    filters. Of LEADERS classes drawn by a hash, the one that has the shared shingle foremost
    leads: little in it is rarer than what the group shares, so it is near the group's middle.
    Leaders are minima, combined before the shuffle."""
    me = ["n", "rep", "pos"]
    draw = F.pmod(F.xxhash64("rep"), F.lit(LEADERS))
    lead = [F.min(F.when(draw == i, F.struct("pos", "n", "rep"))).alias(f"l{i}") for i in range(LEADERS)]
    lead = rows.groupBy("shingle", "grade").agg(F.count(F.lit(1)).alias("m"), *lead).filter("m > 1").select("shingle", "grade", F.array_compact(F.array(*[F.col(f"l{i}") for i in range(LEADERS)])).alias("leaders"))
    pairs = rows.join(lead, ["shingle", "grade"]).select(F.struct(*me).alias("x"), F.explode(F.expr(
        f"filter(leaders, y -> y.rep <> rep AND least(n, y.n) * {rule.den} >= greatest(n, y.n) * {rule.num})")).alias("y"))
    return pairs.filter(_filters(rule, "x", "y")).select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


def _alpha(rule: Rule, na: str, nb: str) -> str:
    """The least intersection of sets that link."""
    return f"(({rule.num} * ({na} + {nb}) + {rule.num + rule.den - 1}) div {rule.num + rule.den})"


def _filters(rule: Rule, x: str, y: str) -> str:
    """Length filter, and the positional filter at a shared shingle."""
    return (f"least({x}.n, {y}.n) * {rule.den} >= greatest({x}.n, {y}.n) * {rule.num} AND "
            f"1 + least({x}.n - {x}.pos, {y}.n - {y}.pos) - 1 >= {_alpha(rule, x + '.n', y + '.n')}")


def _shared(left: list[bytes], right: list[bytes], rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the intersection and of the union of the sets of left[i] and right[i]."""
    d, h = (np.concatenate(c) for c in zip(shingles(left, rule.words), shingles(right, rule.words)))
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    both = np.bincount(d[1:][(d[1:] == d[:-1]) & (h[1:] == h[:-1])], minlength=len(left))
    return both, np.bincount(d, minlength=len(left)) - both


def verified(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs that link. The texts of the documents in them travel compressed, a third of
    what their sets would take; a list of at most SMALL ids is broadcast to find them, a longer
    one is joined."""
    ids = cut(pairs.select(F.col("a").alias("okey")).union(pairs.select(F.col("b").alias("okey"))).distinct(), "ids")
    wanted = docs.join(F.broadcast(ids) if ids.count() <= SMALL else ids, "okey", "left_semi")

    def pack(batches):
        press = zstandard.ZstdCompressor(level=3).compress
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([press(r) for r in _raws(batch.column(1))], pa.binary())], names=["okey", "z"])

    def test(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            left, right, first, size = [], [], 0, 0
            for i in range(len(a)):
                left.append(unpack(batch.column(2)[i].as_py()))
                right.append(unpack(batch.column(3)[i].as_py()))
                size += len(left[-1]) + len(right[-1])
                if size >= SLICE or i == len(a) - 1:
                    both, any_ = _shared(left, right, rule)
                    ok = first + np.flatnonzero(rule.den * both >= rule.num * any_)
                    yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])
                    left, right, first, size = [], [], i + 1, 0

    texts = keep(wanted.mapInArrow(bh.lean(pack), "okey long, z binary"))
    both = pairs.join(texts.select(F.col("okey").alias("a"), F.col("z").alias("za")), "a").join(texts.select(F.col("okey").alias("b"), F.col("z").alias("zb")), "b")
    # several texts of one doc_id are one node
    return both.select("a", "b", "za", "zb").mapInArrow(bh.lean(test), "a long, b long").distinct()


def _blocks(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows; the classes of equal sets (rep is the least okey); their prefixes
    as rows (shingle, rep, n, pos), those that stand in one class alone left out."""
    sig = materialize(signatures(docs, rule, common(docs, rule)), "signatures")
    wide = keep(sig.filter("n > 0").groupBy("s1", "s2").agg(F.min("okey").alias("rep"), F.first("n").alias("n"), F.first("h1").alias("h1"), F.first("h2").alias("h2"), F.first("prefix").alias("prefix")))
    rows = wide.select("rep", "n", F.posexplode("prefix").alias("pos", "shingle"))
    shared = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("shingle")
    rows = materialize(rows.join(shared, "shingle"), "blocks")
    classes = materialize(wide.drop("prefix"), "classes")
    release(wide)
    return sig, classes, rows


def _meetings(rows: DataFrame, rule: Rule, apart: str = "true") -> DataFrame:
    """Pairs of classes that share a prefix shingle and pass the length and positional filters."""
    x, y = rows.alias("x"), rows.alias("y")
    return x.join(y, F.expr(f"x.shingle = y.shingle AND x.rep < y.rep AND {apart} AND {_filters(rule, 'x', 'y')}")).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()


def links(docs: DataFrame, rule: Rule = Rule()) -> tuple[DataFrame, DataFrame]:
    """The join itself: links (a, b) between the representatives of all classes of equal sets,
    none left out, and the membership (okey, n_shingles, rep) of docs(okey, text). A link of two
    documents is a link of their representatives, or they have the same one."""
    sig, classes, rows = _blocks(docs, rule)
    found = verified(cut(_survivors(_meetings(rows, rule), classes, rule), "pairs"), docs, rule)
    members = sig.filter("n > 0").join(classes.select("s1", "s2", "rep"), ["s1", "s2"]).select("okey", F.col("n").alias("n_shingles"), "rep")
    return found, members.union(sig.filter("n = 0").select("okey", "n", "okey"))


def components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """okey, n_shingles, component (an okey) of docs(okey, text)."""
    sig, classes, rows = _blocks(docs, rule)

    # stars first
    grade = F.floor(F.log(F.col("n")) / float(np.log(rule.den / rule.num))).cast("int")
    tried = cut(_survivors(_stars(rows.withColumn("grade", grade), rule), classes, rule), "stars")
    near = cut(verified(tried, docs, rule), "links")
    part = connected_components(near)

    # what is left: pairs of different components, in blocks that hold several
    held = rows.join(part.withColumnRenamed("id", "rep"), "rep", "left").select("shingle", "rep", "n", "pos", F.coalesce("component", "rep").alias("part"))
    mixed = held.groupBy("shingle").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("shingle")
    rest = cut(held.join(mixed, "shingle"), "rest")
    release(rows)
    more = cut(_survivors(_meetings(rest, rule, "x.part <> y.part"), classes, rule).join(tried, ["a", "b"], "left_anti"), "pairs")
    release(rest)
    found = cut(verified(more, docs, rule), "links")
    release(tried, more)
    whole = connected_components(near.union(found))

    # a node is a class's first okey; a node of its own where there is no shingle
    place = classes.select("s1", "s2", "rep").join(whole.withColumnRenamed("id", "rep"), "rep", "left").select("s1", "s2", F.coalesce("component", "rep").alias("component"))
    linked = sig.filter("n > 0").select("okey", "n", "s1", "s2").join(place, ["s1", "s2"]).select("okey", F.col("n").alias("n_shingles"), "component")
    return linked.union(sig.filter("n = 0").select("okey", "n", "okey"))


def keyed(docs: DataFrame) -> DataFrame:
    return long_rows(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL)).alias("okey"), F.coalesce("text", F.lit("")).alias("text"))


def first_of_groups(docs: DataFrame, rule: Rule = Rule(5, 80, 100)) -> DataFrame:
    """docs without the near duplicates of an earlier document: of each component the row with
    the smallest doc_id stays (all rows of that doc_id)."""
    key = free_name(docs, "okey")
    parts = keep(components(keyed(docs), rule).filter("okey <> component").select(F.col("okey").alias(key)).distinct())
    rows = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL)))
    return rows.join(F.broadcast(parts) if parts.count() <= SMALL else parts, key, "left_anti").drop(key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    null = F.lit(NULL)
    return components(keyed(table(spark, sf_dir, "documents"))).select(
        F.nullif(F.col("okey"), null).alias("doc_id"), "n_shingles", F.nullif(F.col("component"), null).alias("component_id"))


#: Every pair of texts, so for small tables; words by ASCII white space, A-Z in lower case.
ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
   ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS i FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 90 GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * i >= 90 * (na + nb - i)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT * FROM (WITH RECURSIVE c(id, c) AS (SELECT doc_id, doc_id FROM s UNION SELECT u.b, c.c FROM c JOIN u ON u.a = c.id) SELECT id, min(c) AS c FROM c GROUP BY id))
SELECT doc_id, len(s) AS n_shingles, r.c AS component_id FROM s JOIN r ON r.id = s.doc_id
"""
