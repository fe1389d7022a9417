import hashlib
import random

import numpy as np
import pytest

from pelagos.llm import op10_suffix_array as op


def brute(rows, length=100):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            w = raw[k:k + length]
            if w in seen:
                gone[k:k + length] = True
            seen.add(w)
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((i, len(raw), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def got(df):
    return sorted(tuple(r) for r in op.digest(df).collect())


@pytest.mark.parametrize("letters", [1, 2, 3, 26])
@pytest.mark.parametrize("n", [1, 2, 9, 400, 2500])
def test_suffix_array(letters, n):
    b = np.random.default_rng(n).integers(0, letters, n).astype(np.uint8)
    if n > 400:
        b[700:1100] = b[100:500]
        b[1500:1700] = 0
    raw, sa = b.tobytes(), op.suffix_array(b)
    assert sorted(sa.tolist()) == list(range(n))
    keys = [raw[i:i + 100] for i in sa]
    assert keys == sorted(keys)


def test_repeats():
    b = np.frombuffer(b"x" * 30 + b"abcdefghij" * 30, np.uint8)
    again = op.repeats(b, np.arange(len(b)) <= len(b) - 100, 100)
    seen, want = set(), []
    for k in range(len(b) - 99):
        w = b[k:k + 100].tobytes()
        want.append(w in seen)
        seen.add(w)
    assert again[:len(want)].tolist() == want and not again[len(want):].any()


def corpus(words):
    rng = random.Random(1)
    passages = [words(40, 1000 + i) for i in range(5)]
    rows = []
    for i in range(60):
        parts = [words(rng.randint(1, 60), i * 7 + j) for j in range(3)]
        if i % 2:
            parts.insert(rng.randint(0, 3), rng.choice(passages)[rng.randint(0, 40):])
        rows.append((i * 3, rng.choice([" ", "\n", ""]).join(parts)))
    rows += [(500 + i, rows[4][1]) for i in range(5)]
    rows += [(600, "ab" * 300), (601, "é" * 200), (602, "z" * 99), (603, "z" * 100), (604, "q" + "z" * 100), (605, ""), (606, None), (607, "\x00" * 250)]
    return rows


def test_against_brute_force(docs, words):
    rows = corpus(words)
    assert got(docs(rows, extra=True)) == brute(rows)


def test_crowded_grams(docs, words, monkeypatch):
    monkeypatch.setattr(op.repeated_spans, "__defaults__", (op.LENGTH, op.GRAM, 2))
    rows = corpus(words)
    assert got(docs(rows)) == brute(rows)


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in op.query(spark, sf).collect()) == brute(rows)


def test_edge_cases(docs, words):
    assert got(docs([])) == []
    t = words(60, 1)
    rows = op.digest(docs([(1, t), (1, t), (2, t), (None, "short")])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in rows) == [("1", 0), ("1", 0), ("2", len(t)), ("None", 0)]
    # texts of one doc_id are documents one after the other
    rows = op.digest(docs([(1, t), (1, t + " more")])).collect()
    assert sorted(r.n_removed > 0 for r in rows) == [False, True]


def test_clean(docs, words):
    t = words(60, 1)
    df = docs([(1, t), (2, t), (3, "head é" + t[:150] + "é tail"), (4, None), (5, "")], extra=True)
    out = {r.doc_id: r for r in op.clean(df).collect()}
    assert op.clean(df).columns == df.columns and sorted(out) == [1, 3, 4, 5]
    assert out[3].text == "head éé tail" and out[3].n_chars == len(out[3].text) and out[4].text is None


@pytest.mark.parametrize("crowd", [1, 3, 8])
def test_crowded_grams_are_halved(docs, words, monkeypatch, crowd):
    monkeypatch.setattr(op.repeated_spans, "__defaults__", (op.LENGTH, op.GRAM, crowd))
    base, rng, rows = words(40, 7), random.Random(2), []
    for i in range(40):  # one passage, its context in few or in all documents the same
        cut, tail = rng.choice([0, 20, 60, 90]), rng.choice([20, 50, 99])
        rows.append((i, words(2, i % 4) + base[cut:cut + 60 + tail] + words(3, i % 6)))
    assert got(docs(rows)) == brute(rows)


@pytest.mark.parametrize("per_file", [20_000, 7])
def test_crowded_grams_take_few_files(spark, docs, words, monkeypatch, per_file):
    """As many files as the rows need, however many tasks find them."""
    monkeypatch.setattr(op.repeated_spans, "__defaults__", (op.LENGTH, op.GRAM, 2))
    monkeypatch.setattr(op, "FILE", per_file)
    put, tables = op.materialize, []

    def spy(df, tag):
        out = put(df, tag)
        if tag == "crowd":
            tables.append((out.count(), len(out.inputFiles())))
        return out

    monkeypatch.setattr(op, "materialize", spy)
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in conf}
    for key in conf:
        spark.conf.set(key, conf[key])
    try:
        rows = corpus(words)
        assert got(docs(rows)) == brute(rows)
    finally:
        for key in conf:
            spark.conf.set(key, before[key])
    assert tables and all(n and files == -(-n // per_file) for n, files in tables)


def test_arrays_decide_between_different_segments(docs, words, monkeypatch):
    """Without what the suffix arrays find, bytes are missing."""
    rows = corpus(words)
    whole = sum(r[2] for r in got(docs(rows)))
    bucket = op._bucket_spans
    monkeypatch.setattr(op, "_bucket_spans", lambda rows, length: bucket(rows, length).slice(0, 0))
    assert sum(r[2] for r in got(docs(rows))) < whole == sum(r[2] for r in brute(rows))


def test_many_texts_of_one_id(docs, words):
    base = words(40, 1)
    rows = [(None if i % 2 else 7, f"{i} {base[:120 + i % 3]} {i * 31}") for i in range(6000)]
    out = op.digest(docs(rows)).collect()
    assert len(out) == 6000 and sum(r.n_removed == 0 for r in out) == 1
    assert all(r.n_removed >= 118 for r in out if r.n_removed)


def test_long_text_and_helper_names(docs, words):
    t = words(50_000, 2)
    rows = [(1, t), (2, "x" + t[1000:200_000]), (3, t[:5000] * 3)]
    assert got(docs(rows)) == brute(rows)
    df = docs([(1, t), (1, words(30, 3)), (2, t)]).selectExpr("*", "1 AS _okey", "2 AS _spans", "3 AS _k", "4 AS _t", "5 AS m")
    out = op.clean(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 1]
