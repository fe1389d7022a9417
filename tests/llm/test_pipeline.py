import inspect
import random

import __spark_entry__ as entry
import corpus_pipeline as pipe
from pelagos.llm import op1_packing, op6_language
from tests.llm.test_jaccard import brute as links
from tests.llm.test_suffix_array import brute as _  # noqa: F401


def fixture(spark):
    """Documents of four languages with copies, near copies and passages."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(160).collect()
    rng = random.Random(2)
    out = [tuple(r) for r in rows]
    for i in range(20):
        r = rng.choice(rows)
        w = r.text.split()
        if i % 2 and len(w) > 60:
            w[30] = "changedword"
        text = " ".join(w)
        out.append((5000 + i, text, r.lang, r.source, len(text)))
    out += [(6000, None, "en", "src1", None), (6001, "12 34 !!", "en", "src1", 8)]
    return spark.createDataFrame(out, rows and spark.read.parquet("/root/testdata/sf0.01/documents.parquet").schema)


def cut(rows, length=100):
    seen, out = set(), []
    for r in sorted(rows):
        raw = r[1].encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            w = raw[k:k + length]
            if w in seen:
                gone[k:k + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
        if kept:
            out.append((r[0], kept))
    return out


def test_stages_against_brute_force(spark):
    docs = fixture(spark).cache()
    stages = dict(pipe.STAGES)
    assert list(stages) == ["language", "near_duplicates", "repeated_passages", "mix", "pack"]

    a = stages["language"](spark, docs, "").cache()
    model = op6_language.train(docs)
    rows = docs.collect()
    langs, scores = op6_language.predict(model, [r.text for r in rows])
    assert sorted(r.doc_id for r in a.collect()) == sorted(r.doc_id for r, x, s in zip(rows, langs, scores) if x != "und" and s >= 0.5)

    b = stages["near_duplicates"](spark, a, "").cache()
    keep = [i for i, _, c in links([(r.doc_id, r.text) for r in a.collect()], 5, 80, 100) if i == c]
    assert sorted(r.doc_id for r in b.collect()) == keep and len(keep) < a.count()

    c = stages["repeated_passages"](spark, b, "").cache()
    assert sorted((r.doc_id, r.text) for r in c.collect()) == cut([(r.doc_id, r.text) for r in b.collect()])

    d = stages["mix"](spark, c, "").cache()
    size, taken, total = {}, {}, 0
    for r in c.collect():
        size[r.source] = size.get(r.source, 0) + len(r.text.split())
        total += len(r.text.split())
    from tests.llm.test_mixing import water
    want = water(size)
    for r in d.collect():
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    longest = max(len(r.text.split()) for r in c.collect())
    assert all(abs(taken.get(s, 0) - want[s]) <= longest for s in want)
    assert all(x.columns == docs.columns for x in (a, b, c, d))

    e = stages["pack"](spark, d, "").collect()
    assert sum(r.length for r in e) == sum(len(op1_packing.encoder()(r.text)) + 1 for r in d.collect())


def test_run_and_registration(spark, sf):
    assert pipe.run(spark, sf).count() > 0 and entry.queries()["pipeline"] is pipe.run
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in entry.queries()) == 1
    assert "except ImportError" in inspect.getsource(entry) and "except" not in inspect.getsource(pipe)


def test_empty_documents(spark):
    docs = fixture(spark).limit(0)
    for _, stage in pipe.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_columns_of_clashing_names(spark):
    extra = "_okey okey _n n _id _t _s _spans spans _text text_ taken size h part component z a b _k".split()
    docs = fixture(spark).limit(60).selectExpr("*", *[f"'x' AS {c}" for c in extra])
    columns = docs.columns
    for name, stage in pipe.STAGES:
        docs = stage(spark, docs, "")
        assert name == "pack" or docs.columns == columns
    assert docs.count() > 0
