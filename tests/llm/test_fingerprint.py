import hashlib
import re
from collections import Counter

import numpy as np

from pelagos.llm import bytehash as bh
from pelagos.llm import op2_fingerprint as op


def pieces(text):
    """The paragraphs of a text: lines, cut after words whose hash is a multiple of CUT."""
    out = []
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words, first = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", line)], None
        for k, (i, j) in enumerate(words):
            first = i if first is None else first
            h = int(bh.spans(bh.sums(np.frombuffer(line[i:j], np.uint8)), np.array([0]), np.array([j - i]))[0])
            if h % op.CUT == 0 or k == len(words) - 1:
                out.append(line[first:j])
                first = None
    return Counter(out)


def brute(a, b):
    x, y = pieces(a), pieces(b)
    n = sum(x.values()) + sum(y.values())
    return 1 - sum(((x - y) + (y - x)).values()) / n if n else 1.0


def expected(rows):
    """(doc_id, text) in order, by hand."""
    out = []
    for i, (k, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        e = t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]
        out.append((k, len(t), hashlib.sha256(e.encode()).hexdigest(), round(brute(t, e), 9), round(brute(t, nxt), 9)))
    return out


def got(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in df.collect()), key=lambda r: r[0])


def test_against_brute_force(docs, words):
    rows = [(3 * i, words(n, i) + "\n" + words(n // 2 + 1, -i)) for i, n in enumerate([1, 30, 400, 3, 80, 2000, 5] * 4)] + [(1000, ""), (1001, ""), (1002, "é𝒳" * 9)]
    assert got(op.fingerprint(docs(rows, extra=True))) == expected(rows)


def test_many_ranges(docs, words, monkeypatch):
    monkeypatch.setattr(op, "PER_RANGE", 3)
    rows = [(i * i, words(20 + i % 7, i)) for i in range(60)]
    assert got(op.fingerprint(docs(rows[::-1]))) == expected(rows)


def test_whole_table(spark, sf):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    assert got(op.query(spark, sf)) == expected(rows)


def test_equal_texts_equal_fingerprints_and_edits_near(docs, words):
    t = words(300, 1)
    r = sorted(op.fingerprint(docs([t, t, words(300, 2)])).collect(), key=lambda r: r.doc_id)
    assert r[0].fingerprint == r[1].fingerprint != r[2].fingerprint
    assert r[0].near_next == 1.0 and r[1].near_next < 0.1 < 0.6 < r[1].near_edited < 1


def test_peeling_recovers_digests(words):
    a = words(400, 1)
    b = a.replace(a.split()[200], "changed", 1)
    doc, key = op.digests([a, b])
    s = op.sketch(doc, key, 2, op.CELLS)
    x, y = (op.text_of(9, *(c[i] for c in s)) for i in (0, 1))
    ka, kb = (set(key[doc == i].tolist()) for i in (0, 1))
    assert op.recover(x, y) == [sorted(ka - kb), sorted(kb - ka)]
    assert op.recover(x, x) == [[], []]


def test_edge_cases(docs):
    assert op.fingerprint(docs([])).count() == 0
    one = op.fingerprint(docs([(7, "alone in here")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    rows = op.fingerprint(docs([(None, None), (5, "b"), (5, "b"), (2, "a " * 50_000)])).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["2", "5", "5", "None"]


def test_many_texts_of_one_id(docs, words):
    rows = [(None if i % 3 else 5, words(3 + i % 4, i)) for i in range(900)] + [(None, "same text")] * 50
    out = op.fingerprint(docs(rows)).collect()
    assert len(out) == 950 and all(r.n_chars >= 0 for r in out)
    # each text follows one other, null ids first
    assert sum(r.near_next == 1.0 and r.n_chars == 9 for r in out) >= 49
