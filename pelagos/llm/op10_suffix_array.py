"""Suffix-array dedup: bytes covered by a 100-byte string that starts earlier are removed.

Which strings can repeat: of the GRAM-byte substrings of a 100-byte window, the one of the
least hash (the leftmost of equals) stands for the window, so equal windows have equal ones
at the same place. Consecutive windows with the same one form a segment. Segments are sorted
by gram and content; of segments that are equal as a whole (two 64-bit hashes; most copies of
a corpus are that) the earliest stays as their representative, and every window of the others
is a repeat. Equal segments of a batch are merged before the shuffle, and the sorted rows are
read as a stream, so a large group of copies is never gathered.

Suffix arrays decide between different segments: representatives that share a gram are
concatenated, a bucket of grams of about BUCKET bytes at a time, in order of their occurrence.
Two-stage sorting orders the suffixes: those smaller than their successor directly, the others
induced by scanning the buckets of first bytes. Adjacent suffixes whose common prefix reaches
100 bytes are equal windows; all but the first occurrence are repeats.

A gram with more than CROWD different representatives (one passage in very many contexts)
would fill an array of its own without bound. Its segments are halved: windows with much
context to the right of the gram take half of what is missing to 100 bytes there into a longer
gram, the others to the left. What is equal then is merged, and the suffix arrays take the
rest as before; what is still crowded is halved again, until the gram is the window.

Defined results: a null text is empty; a null doc_id comes first; equal doc_ids with
different texts are documents one after the other (by a hash of the text), and rows equal in
both are one document that gives as many rows; texts under 100 bytes are kept whole; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagos.llm import bytehash as bh
from pelagos.llm.names import free_name, with_key
from pelagos.session import cut, keep, long_rows, materialize, release, table

NAME = "op10_two_stage_suffixes"
LENGTH, GRAM, BUCKET, CROWD = 100, 40, 1 << 19, 1000
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
AT = 8  # a place: start in the text, and 8 bits of windows
FILE = 20_000  # segments of crowded grams in a file


def _raw(text) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


# ---- candidates


def representatives(b: np.ndarray, starts: np.ndarray, length: int, gram: int):
    """Segments of concatenated texts: hash of the gram, hash of the segment, number of the
    text, start in it, windows. The least gram is found by the upper 33 bits of its hash; the
    31 bits below are its place, so the leftmost of equals wins."""
    s = bh.sums(b)
    h = bh.windows(s, gram)
    n = len(b) - length + 1
    if n <= 0:
        return [np.zeros(0, np.uint64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3]
    least, span, w = (h >> np.uint64(31) << np.uint64(31)) | np.arange(len(h), dtype=np.uint64), 1, length - gram + 1
    while span < w:  # minimum over `span` grams, doubled
        step = min(span, w - span)
        least = np.minimum(least[:len(least) - step], least[step:])
        span += step
    least = least[:n]
    change = np.ones(n, bool)
    change[1:] = least[1:] != least[:-1]
    # windows of a text lie from its start to `length` before its line feed
    from_, to = starts[:-1], starts[1:] - length
    full = to > from_
    change[from_[full]] = True
    edge = np.zeros(n + 1, np.int8)
    np.add.at(edge, from_[full], 1)
    np.add.at(edge, np.minimum(to[full], n), -1)
    valid = np.cumsum(edge[:n]) > 0
    at = np.flatnonzero(change & valid)
    change[np.minimum(to[full], n - 1)] |= to[full] < n
    bounds = np.append(np.flatnonzero(change | ~valid), n)
    stop = bounds[np.searchsorted(bounds, at, side="right")]
    text = np.searchsorted(starts, at, side="right") - 1
    place = (least[at] & np.uint64((1 << 31) - 1)).astype(np.int64)
    return [h[place], bh.spans(s, at, stop + length - 1), text, at - starts[text], stop - at]


def segments(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """h, sh, okey and place of the segments of docs(okey, text). Of equal segments in a batch
    the first stands for all; the others are known copies, spread evenly."""
    def task(batches):
        for batch in (whole.slice(at, 3000) for whole in batches for at in range(0, whole.num_rows, 3000)):
            key = batch.column(0).to_numpy()
            raws = [_raw(t.as_py()) for t in batch.column(1)]
            parts = []
            for first, b, starts in bh.chunks(raws):
                h, sh, text, at, windows = representatives(b, starts, length, gram)
                parts.append((h, sh, key[first + text], at << AT | windows))
            h, sh, okey, place = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((place, okey, sh, h))
            h, sh, okey, place = h[order], sh[order], okey[order], place[order]
            once = np.ones(len(h), bool)  # a repeated row is the same document
            once[1:] = (place[1:] != place[:-1]) | (okey[1:] != okey[:-1]) | (sh[1:] != sh[:-1]) | (h[1:] != h[:-1])
            h, sh, okey, place = h[once], sh[once], okey[once], place[once]
            copy = np.zeros(len(h), bool)
            copy[1:] = (h[1:] == h[:-1]) & (sh[1:] == sh[:-1])
            h = np.where(copy, bh.mix(okey.view(np.uint64) + place.view(np.uint64)), h)
            yield pa.RecordBatch.from_arrays([pa.array(copy), pa.array(h.view(np.int64)), pa.array(sh.view(np.int64)), pa.array(okey), pa.array(place)], names=["copy", "h", "sh", "okey", "place"])

    return docs.select("okey", "text").mapInArrow(bh.lean(task), "copy boolean, h long, sh long, okey long, place long")


def sifted(batches):
    """Rows in the order of (copy, h, sh, okey, place) -> copies of an earlier equal segment, and
    representatives (copy false) of grams that have several. Keeps one row between batches."""
    last = None  # h, sh, okey, place, whether it is one of several already
    row = None  # okey, place of the row before
    names = ["copy", "h", "okey", "place"]
    for batch in batches:
        known, h, sh, okey, place = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(h):
            continue
        kin = np.zeros(len(h), bool)
        same = np.zeros(len(h), bool)
        kin[1:] = h[1:] == h[:-1]
        same[1:] = kin[1:] & (sh[1:] == sh[:-1])
        if last is not None:
            kin[0] = h[0] == last[0]
            same[0] = kin[0] and sh[0] == last[1]
        again = np.zeros(len(h), bool)  # a repeated row is the same document
        again[1:] = (okey[1:] == okey[:-1]) & (place[1:] == place[:-1])
        again[0] = row == (okey[0], place[0])
        row = (okey[-1], place[-1])
        again &= same
        kin[known] = same[known] = False
        copy = (known | same) & ~again
        rep = np.flatnonzero(~copy & ~again)
        out = [copy[copy], h[copy], okey[copy], place[copy]]
        if len(rep):
            several = kin[rep]  # one of the same gram stands before
            if last is not None:
                if several[0] or last[4]:
                    out = [np.append(c, v) for c, v in zip(out, (False, last[0], last[2], last[3]))]
            several[:-1] |= kin[rep[1:]]
            give = rep[:-1][several[:-1]]
            out = [np.concatenate([c, v]) for c, v in zip(out, (np.zeros(len(give), bool), h[give], okey[give], place[give]))]
            r = rep[-1]
            last = (h[r], sh[r], okey[r], place[r], bool(several[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.bool_(), pa.int64(), pa.int64(), pa.int64()))], names=names)
    if last is not None and last[4]:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((False, last[0], last[2], last[3]), (pa.bool_(), pa.int64(), pa.int64(), pa.int64()))], names=names)


# ---- two-stage suffix sorting


def _words(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as numbers in their order."""
    p = np.concatenate([b, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(b), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | p[i:i + len(b)]
    return out


def _smaller(b: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor."""
    n = len(b)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(b[1:].astype(np.int16) - b[:-1])
    step[-1:] = -1
    nxt = np.where(step != 0, np.arange(n), n)
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    return step[nxt] > 0


def _direct(at: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """Sorts the suffixes at `at` by their first `depth` bytes: eight at a time, and only those
    not yet apart."""
    pad = np.concatenate([word, np.zeros(depth + 8, np.uint64)])
    order = at[np.argsort(pad[at], kind="stable")]
    same = np.concatenate([[False], pad[order[1:]] == pad[order[:-1]]]) if len(order) else np.zeros(0, bool)
    for d in range(8, depth, 8):
        tied = same.copy()
        tied[:-1] |= same[1:]
        i = np.flatnonzero(tied)
        if not len(i):
            break
        group = np.cumsum(~same[i])
        sub = order[i]
        key = pad[sub + d]
        o = np.argsort(key, kind="stable")
        o = o[np.argsort(group[o], kind="stable")]
        order[i] = sub[o]
        key, group = key[o], group[o]
        same[i] = np.concatenate([[False], (key[1:] == key[:-1]) & (group[1:] == group[:-1])])
    return order


def suffix_array(b: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """All suffixes in the order of their first `depth` bytes (at least)."""
    n = len(b)
    if not n:
        return np.zeros(0, np.int64)
    small = _smaller(b)
    word = _words(b)
    direct = _direct(np.flatnonzero(small), word, depth + 8)
    bounds = np.searchsorted(b[direct], np.arange(257))
    queue: list[list[np.ndarray]] = [[] for _ in range(256)]
    queue[b[-1]].append(np.array([n - 1]))
    out = []

    def induce(placed: np.ndarray, c: int) -> np.ndarray | None:
        """Puts the larger-than-successor suffixes before `placed` into their buckets; those of
        bucket c itself are returned."""
        before = placed[placed > 0] - 1
        before = before[~small[before]]
        if not len(before):
            return None
        head = b[before]
        o = np.argsort(head, kind="stable")
        cut = np.flatnonzero(np.diff(head[o])) + 1
        own = None
        for part in np.split(before[o], cut):
            d = b[part[0]]
            if d == c:
                own = part
            else:
                queue[d].append(part)
        return own

    for c in range(256):
        todo = np.concatenate(queue[c]) if queue[c] else None
        while todo is not None and len(todo):
            out.append(todo)
            todo = induce(todo, c)
        placed = direct[bounds[c]:bounds[c + 1]]
        if len(placed):
            out.append(placed)
            induce(placed, c)
    return np.concatenate(out)


def repeats(b: np.ndarray, valid: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Places of valid windows that equal a valid window at an earlier place."""
    word = np.concatenate([_words(b), np.zeros(length, np.uint64)])
    sa = suffix_array(b, length)
    sa = sa[valid[sa]]
    if len(sa) < 2:
        return np.zeros(len(b), bool)
    equal = np.flatnonzero(word[sa[1:]] == word[sa[:-1]])  # adjacent common prefixes
    for d in [*range(8, length - 8, 8), length - 8]:
        equal = equal[word[sa[equal + 1] + d] == word[sa[equal] + d]]
    joined = np.zeros(len(sa), bool)
    joined[equal + 1] = True
    heads = np.flatnonzero(~joined)
    first = np.minimum.reduceat(sa, heads)
    out = np.zeros(len(b), bool)
    out[sa] = sa != np.repeat(first, np.diff(np.append(heads, len(sa))))
    return out


def _bucket_spans(rows: pa.Table, length: int) -> pa.Table:
    """The repeated spans of one bucket of representatives."""
    okey, place = (rows.column(c).to_numpy() for c in ("okey", "place"))
    order = np.lexsort((place, okey))
    okey, place = okey[order], place[order]
    b = np.frombuffer(b"".join(rows.column("bytes").take(pa.array(order)).to_pylist()), np.uint8)
    windows = place & 0xFF
    begin = np.concatenate([[0], np.cumsum(windows + length - 1)])
    inside = np.arange(len(b)) - np.repeat(begin[:-1], np.diff(begin))
    valid = inside < np.repeat(windows, np.diff(begin))
    again = repeats(b, valid, length)
    edge = np.diff(np.concatenate([[0], (again & valid).astype(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    seg = np.searchsorted(begin, start, side="right") - 1  # windows of two segments never touch
    at = (place >> AT)[seg] + start - begin[seg]
    return pa.table({"okey": okey[seg], "a": at, "b": at + (stop - start) + length - 1})


# ---- crowded grams


def halved(batches, length: int):
    """Rows of segments (okey, place, bytes, g: place of the gram in them, size: its bytes) ->
    their halves, with hashes of the longer gram and of the whole segment."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            b = whole.slice(at, 1000)
            out = []
            for key, place, raw, g, size in zip(*(b.column(c).to_pylist() for c in ("okey", "place", "bytes", "g", "size"))):
                n, start, lack = place & 0xFF, place >> AT, length - size
                first = min(n, max(0, g - lack // 2))  # windows before this one have much to the left
                for lo, hi, left, right in ((0, first, g - lack // 2 - 1, g + size), (first, n, g, g + size + -(-lack // 2))):
                    if lo < hi:
                        out.append((raw[lo:hi + length - 1], left, right, lo, hi, key, (start + lo) << AT | hi - lo))
            if out:
                b_, starts = bh._join([o[0] for o in out])
                sums, begin = bh.sums(b_), starts[:-1]
                left, right, lo = (np.array([o[i] for o in out], np.int64) for i in (1, 2, 3))
                h = bh.spans(sums, begin + left - lo, begin + right - lo)
                sh = bh.spans(sums, begin, starts[1:] - 1)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h.view(np.int64), sh.view(np.int64), [o[5] for o in out], [o[6] for o in out])] + [pa.array([o[0] for o in out], pa.binary()), pa.array(left - lo), pa.array(right - left)], names=["h", "sh", "okey", "place", "bytes", "g", "size"])


def _found(batches, gram: int):
    """Adds g and size: the leftmost place of the gram of hash `group` that all windows hold."""
    for b in batches:
        g = []
        for h, place, raw in zip(b.column("group").to_pylist(), b.column("place").to_pylist(), b.column("bytes").to_pylist()):
            hashes = bh.windows(bh.sums(np.frombuffer(raw, np.uint8)), gram).view(np.int64)
            low = (place & 0xFF) - 1
            g.append(low + int(np.flatnonzero(hashes[low:] == h)[0]))
        yield pa.RecordBatch.from_arrays([b.column(c) for c in ("okey", "place", "bytes")] + [pa.array(g, pa.int64()), pa.array([gram] * len(g), pa.int64())], names=["okey", "place", "bytes", "g", "size"])


def _put_down(rows: DataFrame, n: int) -> DataFrame:
    """n rows of crowded grams in as many files as they need, not one from each task: a task has
    few of them, and each file in a local folder starts processes (see README)."""
    return materialize(rows.repartition(-(-n // FILE)), "crowd")


def uncrowded(many: DataFrame, n: int, length: int, gram: int, crowd: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """many(group: hash of the gram, okey, place, bytes), n rows, of crowded grams -> copies of
    earlier segments (okey, place), and representatives (h, okey, place, bytes) of grams that have
    several, `crowd` at most. Each round halves what is missing between gram and window."""
    rows = _put_down(many.mapInArrow(bh.lean(lambda x: _found(x, gram)), "okey long, place long, bytes binary, g long, size long"), n)
    copies, few = [], []
    while True:
        halves = materialize(rows.mapInArrow(bh.lean(lambda x: halved(x, length)), "h long, sh long, okey long, place long, bytes binary, g long, size long"), "halves")
        release(rows)
        me = F.struct("okey", "place")
        heads = cut(halves.groupBy("h", "sh").agg(F.min(me).alias("head"), F.count(F.lit(1)).alias("n")), "heads")
        copies.append(halves.join(heads.filter("n > 1"), ["h", "sh"]).filter(me != F.col("head")).select("okey", "place"))
        kinds = cut(heads.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "kinds")
        reps = halves.join(heads, ["h", "sh"]).filter(me == F.col("head")).select("h", "okey", "place", "bytes", "g", "size")
        few.append(reps.join(kinds.filter(F.col("kinds") <= crowd).select("h"), "h", "left_semi").select("h", "okey", "place", "bytes"))
        n = kinds.filter(F.col("kinds") > crowd).agg(F.sum("kinds")).first()[0]  # a representative of each kind
        if n is None:
            return copies, few
        rows = _put_down(reps.join(kinds.filter(F.col("kinds") > crowd).select("h"), "h", "left_semi").select("okey", "place", "bytes", "g", "size"), n)


# ---- whole corpus


def keyed(docs: DataFrame) -> DataFrame:
    docs = long_rows(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return with_key(docs, "okey")


def compressed(docs: DataFrame) -> DataFrame:
    """okey, doc_id and the text as zstd: what is shuffled."""
    def task(batches):
        press = zstandard.ZstdCompressor(level=1).compress
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([press(_raw(t.as_py())) for t in b.column(2)], pa.binary())], names=["okey", "doc_id", "z"])

    return docs.select("okey", "doc_id", "text").mapInArrow(bh.lean(task), "okey long, doc_id long, z binary")


def cut_out(docs: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """places(okey, place, group) with the bytes of the segment, from the texts."""
    def task(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                okey, place, group, data = [], [], [], []
                for key, z, got in zip(*(whole.slice(at, 500).column(i) for i in range(3))):
                    raw, own = unpack(z.as_py()), got.values
                    p = own.field("place").to_numpy()
                    start = p >> AT
                    okey.append(np.full(len(p), key.as_py()))
                    place.append(p)
                    group.append(own.field("group").to_numpy())
                    data += [raw[i:j] for i, j in zip(start.tolist(), (start + (p & 0xFF) + length - 1).tolist())]
                if data:
                    yield pa.RecordBatch.from_arrays([*[pa.array(np.concatenate(c)) for c in (group, okey, place)], pa.array(data, pa.binary())], names=["group", "okey", "place", "bytes"])

    per_doc = places.groupBy("okey").agg(F.collect_set(F.struct("group", "place")).alias("places"))
    return compressed(docs).select("okey", "z").join(per_doc, "okey").select("okey", "z", "places").mapInArrow(bh.lean(task), "group long, okey long, place long, bytes binary")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """okey, spans(a, b): what (in bytes) of docs(okey, text) repeats earlier strings of `length`."""
    sorted_ = segments(docs, length, gram).repartition("h").sortWithinPartitions("copy", "h", "sh", "okey", "place")
    sift = materialize(sorted_.mapInArrow(bh.lean(sifted), "copy boolean, h long, okey long, place long"), "segments")
    start = F.shiftright("place", AT)
    spans = ["okey", start.alias("a"), (start + F.col("place").bitwiseAND(0xFF) + length - 1).alias("b")]

    reps = sift.filter("NOT copy")
    crowded = cut(reps.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).filter(F.col("kinds") > crowd), "crowded")
    n = crowded.agg(F.sum("kinds")).first()[0]
    few = reps.join(crowded, "h", "left_anti")
    total = few.agg(F.coalesce(F.sum(F.col("place").bitwiseAND(0xFF) + length - 1), F.lit(0))).first()[0]
    buckets = max(1, -(-total // BUCKET))

    def arrays(rows: DataFrame) -> DataFrame:
        return keep(rows.groupBy("group").applyInArrow(lambda t: _bucket_spans(t, length), "okey long, a long, b long"))

    bucket = F.pmod(F.xxhash64("h"), F.lit(buckets)).alias("group")
    out = sift.filter("copy").select(*spans).unionByName(arrays(cut_out(docs, few.select("okey", "place", bucket), length)))
    if n is not None:
        many = cut_out(docs, reps.join(crowded, "h", "left_semi").select("okey", "place", F.col("h").alias("group")), length)
        copies, halves = uncrowded(many, n, length, gram, crowd)
        rows = reduce(DataFrame.unionByName, halves)
        out = reduce(DataFrame.unionByName, [c.select(*spans) for c in copies], out).unionByName(arrays(rows.select("okey", "place", "bytes", bucket)))
    return out.groupBy("okey").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def _merged(raw: bytes, spans) -> tuple[np.ndarray, int]:
    """Which bytes go, and the number of their runs."""
    step = np.zeros(len(raw) + 1, np.int32)
    if spans is not None and len(spans):
        np.add.at(step, spans.field("a").to_numpy(), 1)
        np.add.at(step, spans.field("b").to_numpy(), -1)
    gone = np.cumsum(step)[:-1] > 0
    return gone, int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())


def digest(docs: DataFrame) -> DataFrame:
    docs = keyed(docs)
    spans = repeated_spans(docs)

    def task(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        types = [pa.int64()] * 4 + [pa.string()]
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                rows = []
                for key, z, got in zip(*(whole.slice(at, 1000).column(i) for i in range(3))):
                    raw, removed, runs = unpack(z.as_py()), 0, 0
                    kept = raw
                    if got.is_valid:
                        gone, runs = _merged(raw, got.values)
                        removed = int(gone.sum())
                        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    rows.append((key.as_py(), len(raw), removed, runs, hashlib.sha256(kept).hexdigest()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return compressed(docs).join(spans, "okey", "left").select("doc_id", "z", "spans").mapInArrow(bh.lean(task), SCHEMA)


def clean(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with repeated bytes cut from the text and n_chars set to it; a document of which
    nothing is left goes. A character cut in the middle goes whole."""
    cols, okey, held = docs.columns, free_name(docs, "okey"), free_name(docs, "spans")
    rows = with_key(long_rows(docs), okey)
    spans = repeated_spans(rows.select(F.col(okey).alias("okey"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), length)
    joined = rows.join(spans.select(F.col("okey").alias(okey), F.col("spans").alias(held)), okey, "left").select(*cols, held)

    def task(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                texts, keep_ = b.column("text").to_pylist(), []
                for i, got in enumerate(b.column(held)):
                    if got.is_valid:
                        raw = _raw(texts[i])
                        gone, _ = _merged(raw, got.values)
                        texts[i] = np.frombuffer(raw, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
                    if not got.is_valid or texts[i]:
                        keep_.append(i)
                arrays = [pa.array(texts, pa.string()) if c == "text" else pa.array([None if t is None else len(t) for t in texts], b.schema.field(c).type) if c == "n_chars" else b.column(c) for c in cols]
                yield pa.RecordBatch.from_arrays(arrays, names=cols).take(pa.array(keep_, pa.int64()))

    return joined.mapInArrow(bh.lean(task), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))


ORACLE_SQL = None  # tested against a brute-force version
