"""Document fingerprints: an invertible Bloom lookup sketch of paragraph digests.

A paragraph is a line; a long line is cut after words chosen by their hash, so an edit
touches only the pieces around it. A repeated paragraph gets a digest for each repetition.
Each digest goes into one cell of each of three subtables (count, xor of digests, xor of
checks). The sketches of two versions subtract cell by cell; peeling the cells that hold one
digest recovers the differing ones, and where it gets stuck both are sketched again four
times as large. Likeness is the shared part of all paragraphs: 1 - differing / (n1 + n2).

The next document in order of doc_id comes from a range partitioning whose bounds are
approximate quantiles: inside a range the rows stream in order, and the first row of each
range is copied to the range before. There are MOST_RANGES ranges at most, so what the
driver holds is bounded; a range is read as a stream.

Defined results: a null text is empty, and two empty texts are alike (1.0); null doc_ids come
first; equal doc_ids stand in the order of a hash of their texts and follow one another; a
single document is its own next; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagos.llm import bytehash as bh
from pelagos.llm.names import with_key
from pelagos.session import long_rows, table

NAME = "op2_invertible_bloom"
CELLS, GROW, CUT, PER_RANGE, MOST_RANGES = 24, 4, 8, 4096, 20_000
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


# ---- sketches of many texts at once


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, digest) of every paragraph of every text, sorted."""
    docs, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for first, b, starts in bh.chunks(texts):
        s = bh.sums(b)
        start, end = bh.words(b)
        if not len(start):
            continue
        cut = bh.spans(s, start, end) % np.uint64(CUT) == 0
        lines = np.flatnonzero(b == 10)  # a text ends with a line feed here
        line = np.searchsorted(lines, start)
        cut[:-1] |= line[1:] != line[:-1]
        cut[-1] = True
        last = np.flatnonzero(cut)
        begin = np.concatenate([[0], last[:-1] + 1])
        docs.append(np.searchsorted(starts, start[begin], side="right") - 1 + first)
        keys.append(bh.spans(s, start[begin], end[last]))
    doc, key = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    if len(doc):  # the k-th repetition in a text
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])
        at = np.flatnonzero(new)
        again = np.arange(len(doc)) - np.repeat(at, np.diff(np.append(at, len(doc))))
        key = np.where(again > 0, bh.mix(key + again.astype(np.uint64)), key)
    return doc, key


def _check(key: np.ndarray) -> np.ndarray:
    return (bh.mix(key ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


def _places(row: np.ndarray, key: np.ndarray, cells: int) -> np.ndarray:
    """Flat places, (3, n): one cell in each third."""
    sub = cells // 3
    return np.stack([row * cells + i * sub + (bh.mix(key + np.uint64(i + 1)) % np.uint64(sub)).astype(np.int64) for i in range(3)])


def sketch(row: np.ndarray, key: np.ndarray, rows: int, cells: int):
    """count, xor of digests and xor of checks: arrays (rows, cells)."""
    count, xor, check = np.zeros(rows * cells, np.int32), np.zeros(rows * cells, np.uint64), np.zeros(rows * cells, np.uint32)
    c = _check(key)
    for at in _places(row, key, cells):
        count += np.bincount(at, minlength=rows * cells).astype(np.int32)
        np.bitwise_xor.at(xor, at, key)
        np.bitwise_xor.at(check, at, c)
    return count.reshape(rows, cells), xor.reshape(rows, cells), check.reshape(rows, cells)


def peel(count, xor, check):
    """Subtracted sketches (rows, cells) -> per row the number of differing digests, -1 where
    peeling gets stuck, and the recovered (row, digest, sign)."""
    rows, cells = count.shape
    count, xor, check = count.reshape(-1).copy(), xor.reshape(-1).copy(), check.reshape(-1).copy()
    found, got = np.zeros(rows, np.int64), []
    look = np.arange(len(count))
    while True:
        one = look[np.abs(count[look]) == 1]
        one = one[_check(xor[one]) == check[one]]
        if not len(one):
            break
        row, key, sign = one // cells, xor[one], count[one]
        _, first = np.unique(np.stack([row.astype(np.uint64), key]), axis=1, return_index=True)
        row, key, sign = row[first], key[first], sign[first]
        found += np.bincount(row, minlength=rows)
        got.append((row, key, sign))
        c, look = _check(key), []
        for at in _places(row, key, cells):
            np.subtract.at(count, at, sign)
            np.bitwise_xor.at(xor, at, key)
            np.bitwise_xor.at(check, at, c)
            look.append(at)
        look = np.unique(np.concatenate(look))
        if found.sum() > 2 * rows * cells:  # checks that hold by chance
            break
    stuck = (count.reshape(rows, cells) != 0).any(1) | (xor.reshape(rows, cells) != 0).any(1)
    found[stuck] = -1
    return found, got


def differing(doc: np.ndarray, key: np.ndarray, n: int, a: np.ndarray, b: np.ndarray, base=None) -> np.ndarray:
    """Number of digests in which the texts a[i] and b[i] differ, by subtracting and peeling."""
    bounds = np.searchsorted(doc, np.arange(n + 1))
    out, todo, cells = np.full(len(a), -1, np.int64), np.arange(len(a)), CELLS
    while len(todo):
        if base is not None and cells == CELLS:
            diff = [x[a] - x[b] if x.dtype == np.int32 else x[a] ^ x[b] for x in base]
        else:
            sides = []
            for side in (a[todo], b[todo]):
                size = bounds[side + 1] - bounds[side]
                row = np.repeat(np.arange(len(todo)), size)
                at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(bounds[side], size)
                sides.append(sketch(row, key[at], len(todo), cells))
            diff = [x - y if x.dtype == np.int32 else x ^ y for x, y in zip(*sides)]
        out[todo], _ = peel(*diff)
        todo = todo[out[todo] < 0]
        cells *= GROW
    return out


def text_of(n: int, count, xor, check) -> str:
    return f"{n}:" + base64.b64encode(count.astype("<i4").tobytes() + xor.astype("<u8").tobytes() + check.astype("<u4").tobytes()).decode()


def recover(a: str, b: str):
    """The digests in which two fingerprints differ, (only in a, only in b); None if CELLS are too few."""
    def parse(t):
        n, raw = t.split(":")
        raw = base64.b64decode(raw)
        return np.frombuffer(raw[:4 * CELLS], "<i4"), np.frombuffer(raw[4 * CELLS:12 * CELLS], "<u8"), np.frombuffer(raw[12 * CELLS:], "<u4")
    (c1, x1, k1), (c2, x2, k2) = parse(a), parse(b)
    found, got = peel((c1 - c2)[None], (x1 ^ x2)[None], (k1 ^ k2)[None])
    if found[0] < 0:
        return None
    return [sorted(int(k) for _, key, sign in got for k, s in zip(key, sign) if s == want) for want in (1, -1)]


def edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def fingerprints(ids: list, texts: list[str]) -> list[tuple]:
    """Result rows of all but the last text, each of which is followed by the next."""
    n = len(texts) - 1
    ed = [edited(t, f) for t, f in zip(texts, texts[1:])]
    doc, key = digests(texts + ed)
    total = 2 * n + 1
    base = sketch(doc, key, total, CELLS)
    size = np.bincount(doc, minlength=total)
    i = np.arange(n)
    near = []
    for other in (i + n + 1, i + 1):
        both = size[i] + size[other]
        near.append(1 - differing(doc, key, total, i, other, base) / np.maximum(both, 1))
    fp = [text_of(int(size[j]), base[0][j], base[1][j], base[2][j]) for j in range(total)]
    return [(ids[j], len(texts[j]), hashlib.sha256(ed[j].encode("utf-8", "surrogatepass")).hexdigest(), fp[j], fp[n + 1 + j], round(float(near[0][j]), 9), round(float(near[1][j]), 9)) for j in range(n)]


# ---- the next document


def ranges(docs: DataFrame) -> tuple[np.ndarray, dict[int, int]]:
    """Bounds of the ranges, and for the first key of a range the range that needs it as a
    guest. MOST_RANGES of each at most."""
    n = docs.count()
    parts = max(1, min(MOST_RANGES, -(-n // PER_RANGE)))
    probs = [i / parts for i in range(1, parts)]
    bounds = np.unique(np.array([int(x) for x in docs.approxQuantile("okey", probs, 0.25 / parts)] if probs else [], np.int64))

    def least(batches):
        for b in batches:
            key = b.column(0).to_numpy()
            part = np.searchsorted(bounds, key, side="right")
            p, inv = np.unique(part, return_inverse=True)
            m = np.full(len(p), np.iinfo(np.int64).max)
            np.minimum.at(m, inv, key)
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(m)], names=["part", "okey"])

    firsts = sorted((r.part, r.okey) for r in docs.select("okey").mapInArrow(bh.lean(least), "part int, okey long").groupBy("part").agg(F.min("okey").alias("okey")).collect())
    return bounds, {key: firsts[i - 1][0] for i, (_, key) in enumerate(firsts)}


def ordered(docs: DataFrame) -> DataFrame:
    """part, guest, okey, doc_id, z (the compressed text), sorted inside each part."""
    docs = with_key(long_rows(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), "okey").select("okey", "doc_id", "text")
    bounds, guests = ranges(docs)
    keys = np.array(sorted(guests), np.int64)

    def deal(batches):
        press = zstandard.ZstdCompressor(level=1).compress
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                okey = b.column(0).to_numpy()
                part = np.searchsorted(bounds, okey, side="right").astype(np.int32)
                guest = np.flatnonzero(np.isin(okey, keys))
                z = [press(t.as_py().encode("utf-8", "surrogatepass")) for t in b.column(2)]
                rows = np.concatenate([np.arange(len(okey)), guest])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([part, np.array([guests[int(okey[i])] for i in guest], np.int32)])),
                    pa.array(np.arange(len(rows)) >= len(okey)), b.column(0).take(pa.array(rows)), b.column(1).take(pa.array(rows)), pa.array([z[i] for i in rows], pa.binary())],
                    names=["part", "guest", "okey", "doc_id", "z"])

    dealt = docs.mapInArrow(bh.lean(deal), "part int, guest boolean, okey long, doc_id long, z binary")
    return dealt.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", "guest", "okey", "z")


def streamed(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    part, closed, ids, texts, size = None, False, [], [], 0

    def flush():
        nonlocal ids, texts, size
        rows = fingerprints(ids, texts) if len(texts) > 1 else []
        ids, texts = ids[-1:], texts[-1:]
        size = sum(map(len, texts))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names) if rows else None

    for b in batches:
        for p, guest, doc, z in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(4)):
            if p != part:
                if (rows := flush()) is not None:
                    yield rows
                part, closed, ids, texts, size = p, False, [], [], 0
            if closed:
                continue
            closed = guest
            ids.append(doc)
            texts.append(unpack(z.as_py()).decode("utf-8", "surrogatepass"))
            size += len(texts[-1])
            if size > most and not guest:
                if (rows := flush()) is not None:
                    yield rows
    if (rows := flush()) is not None:
        yield rows


def fingerprint(docs: DataFrame) -> DataFrame:
    return ordered(docs).mapInArrow(bh.lean(streamed), SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(table(spark, sf_dir, "documents"))


ORACLE_SQL = None  # sketches are tested against brute force
