import zlib

import pytest

from pelagos.llm import op6_language as op


@pytest.fixture(scope="module")
def model(spark):
    return op.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_accuracy(spark):
    rows = op.query(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98


def test_code_switched_words(spark, model):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("n_chars > 500").orderBy("doc_id").collect()
    a, b = next(r.text for r in rows if r.lang == "en"), next(r.text for r in rows if r.lang == "fr")
    labels = [y for _, y, _ in op.label_words(model, " ".join(a.split()[:40] + b.split()[:40]))]
    assert labels[:40].count("en") > 34 and labels[40:].count("fr") > 34


def test_posteriors_by_enumeration():
    import itertools

    import numpy as np
    rng = np.random.default_rng(0)
    e, t = rng.normal(size=(4, 3)).astype("f4"), rng.normal(size=(3, 3)).astype("f4")
    m, pair = op.posterior(e, np.zeros(4, int), np.arange(4), t)
    want, want_pair, z = np.zeros((4, 3)), np.zeros((3, 3)), 0
    for path in itertools.product(range(3), repeat=4):
        p = np.exp(sum(e[i, y] for i, y in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))
        z += p
        for i, y in enumerate(path):
            want[i, y] += p
        for a, b in zip(path, path[1:]):
            want_pair[a, b] += p
    assert np.allclose(m, want / z, atol=1e-4) and np.allclose(pair, want_pair / z, atol=1e-3)


@pytest.mark.parametrize("chain", [1, 2, 3, 5])
def test_messages_between_blocks_are_exact(monkeypatch, chain):
    import numpy as np
    rng = np.random.default_rng(1)
    doc = np.repeat(np.arange(7), [1, 2, 13, 3, 30, 4, 5])
    e, t = rng.normal(size=(len(doc), 4)).astype("f4"), rng.normal(size=(4, 4)).astype("f4")
    got = []
    for size in (chain, 64):
        monkeypatch.setattr(op, "CHAIN", size)
        blocks, place, linked = op.chains(doc)
        got.append(op.posterior(e, blocks, place, t, linked))
    assert np.allclose(got[0][0], got[1][0], atol=1e-5) and np.allclose(got[0][1], got[1][1], atol=1e-4)


def test_transitions_keep_a_language(model):
    import numpy as np
    assert (np.diag(model.trans) > model.trans.max(1, where=~np.eye(len(model.langs), dtype=bool), initial=-9)).all()


def test_edge_cases(docs, model):
    df = docs([(1, None), (2, ""), (3, "123 ... $$$"), (None, "the of and that is"), (5, "the " * 40_000), (6, "ı\x00é")], extra=True)
    got = {r.doc_id: r for r in op.identify(df, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3))
    assert got[5].lang_pred == "en" and got[None].lang_pred == "en" and got[None].held_out is False and got[6].lang_pred != "und"
    assert op.identify(docs([]), model).count() == 0
    unlabelled = docs([(1, "some words here", None)])
    assert op.train(unlabelled) is None and op.identify(unlabelled, None).first().lang_pred == "und"


def test_kept_languages(docs, model):
    df = docs([(1, None), (2, "the of and that is with for"), (3, "!!!")], extra=True)
    out = op.kept_languages(df, model)
    assert out.columns == df.columns and [r.doc_id for r in out.collect()] == [2]
