"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

A document's ids and the end id are cut: whole windows first, the rest into pieces of at
most PIECE ids, every EVERYth rest into pieces of at most FINE ids that even windows out. The pieces of a bounded group are packed together: every piece starts as a
partial partition of k windows; the two partial partitions with the largest imbalance are
merged, the fullest windows of one onto the emptiest of the other, until one is left. Its
windows are nearly equal; if the fullest exceeds the capacity, k rises and it is done again.

A task packs the rows it reads, GROUP windows at a time, and keeps nothing else in memory:
there is no shuffle, and a hot source or a very long text changes nothing. A lost executor
costs the tasks that ran there, and they give the same rows again.

Defined results: a null text counts as empty and has the end id alone; a null doc_id stays
null; repeated rows are packed each; an empty table gives no rows; other columns of the
input are ignored.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from pelagos.llm import bytehash as bh
from pelagos.session import long_rows, table

NAME = "op1_karmarkar_karp"
WINDOW, PIECE, FINE, EVERY, GROUP, END = 2048, 512, 48, 10, 256, 1
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_encode: dict[str, Callable] = {}


def encoder(path: str | None = None) -> Callable[[str], list[int]]:
    """Ids of a byte-level BPE file for `tokenizers`.

    tiktoken runs the same merges several times faster, so the vocabulary of the file is
    handed to it; tests hold the ids against `tokenizers` itself.
    """
    import json

    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    if path not in _encode:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(byte[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        bpe = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        _encode[path] = lambda text: bpe.encode(text, allowed_special="all") if any(s in text for s in special) else bpe.encode_ordinary(text)
    return _encode[path]


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: the items of each of k windows. Partial partitions keep only their
    windows that hold something, fullest first; the others are empty."""
    heap = [(-s, i, [(s, (i,))]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        over = len(a) + len(b) - k
        if over <= 0:
            merged = a + b
        else:  # the fullest of one meet the emptiest of the other
            free = len(a) - over
            merged = a[:free] + [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[free:], reversed(b[len(b) - over:]), strict=True)] + b[: len(b) - over]
        merged.sort(key=lambda x: -x[0])
        least = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (least - merged[0][0], n, merged))
        n += 1
    return [list(w[1]) for w in heap[0][2]] if heap else []


def pack(sizes: list[int], capacity: int = WINDOW) -> list[list[int]]:
    """As few nearly equal windows as differencing fits under the capacity; no size exceeds it."""
    k = max(1, -(-sum(sizes) // capacity))
    while sizes:
        windows = difference(sizes, k)
        if max(sum(sizes[i] for i in w) for w in windows) <= capacity:
            return windows
        k += 1
    return []


def packed(batches: Iterator[pa.RecordBatch], first_id: int, path: str | None, window: int, piece: int, group: int) -> Iterator[pa.RecordBatch]:
    """Packs the documents of one task; sequence ids count from first_id."""
    encode, types = encoder(path), [pa.int64()] * 7
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    seq, held, held_ids, rests, out = first_id, [], 0, 0, []

    def flush():
        nonlocal seq, held, held_ids
        for w in pack([p[2] for p in held], window):
            at = 0
            for i in w:
                out.append((*held[i], seq, at))
                at += held[i][2]
            seq += 1
        held, held_ids = [], 0

    def rows():
        got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
        out.clear()
        return got

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = np.array([*encode(text.as_py() or ""), END], "<u4")
            n = len(ids)
            whole = n - n % window
            for at in range(0, whole, window):
                out.append((doc, at, window, zlib.crc32(ids[at:at + window].tobytes()), n, seq, 0))
                seq += 1
            rests += n > whole
            parts = -(-(n - whole) // (FINE if rests % EVERY == 0 else piece))
            cuts = [whole + (n - whole) * i // parts for i in range(parts + 1)] if parts else []
            for a, b in zip(cuts, cuts[1:]):
                held.append((doc, a, b - a, zlib.crc32(ids[a:b].tobytes()), n))
            held_ids += n - whole
            if held_ids >= group * window:
                flush()
            if len(out) >= 20_000:
                yield rows()
    flush()
    if out:
        yield rows()


def pack_documents(docs: DataFrame, path: str | None = None, window: int = WINDOW, piece: int = PIECE, group: int = GROUP) -> DataFrame:
    """A row for each piece; sequence ids of a task start at its number times 2**36."""
    def task(batches):
        yield from packed(batches, TaskContext.get().partitionId() << 36, path, window, piece, group)

    return long_rows(docs).selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(bh.lean(task), SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


ORACLE_SQL = None  # BPE and differencing are tested against brute force
