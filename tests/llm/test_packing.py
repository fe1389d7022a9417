import zlib
from collections import defaultdict

import numpy as np
import pytest

from pelagos.llm import op1_packing as op


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_tokenizers(spark, reference):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(300).collect()
    odd = ["", " ", "\n\n\t x", "a<|endoftext|>b", "naïve  ﬁ १२३ 𝒳 ​ é", "'s 'LL don't  ", "  x\x00y"]
    for t in [r.text for r in rows] + odd:
        assert list(op.encoder()(t)) == reference.encode(t, add_special_tokens=False).ids


def test_differencing_is_near_the_mean():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 500, 400).tolist()
    for k in (1, 2, 7, 40):
        w = op.difference(sizes, k)
        assert sorted(i for x in w for i in x) == list(range(400))
        sums = [sum(sizes[i] for i in x) for x in w]
        assert len(sums) == k and max(sums) - min(sums) <= max(2, 0.02 * sum(sums) / k)


def test_windows_rise_until_they_fit():
    w = op.pack([1500, 1500, 1500], 2048)
    assert len(w) == 3 and op.pack([], 2048) == []


def check(rows, texts, reference):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for doc, text in texts.items():
        ids = reference.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_round_trip(docs, words, reference):
    texts = {i: words(n, i) for i, n in enumerate([1, 5, 900, 40, 3000, 12, 700] * 6)}
    texts |= {100: "", 101: None, 102: "x"}
    check(op.pack_documents(docs([(k, v) for k, v in texts.items()], extra=True)).collect(), texts, reference)


def test_little_padding(spark):
    rows = op.query(spark, "/root/testdata/sf0.01").collect()
    ids = sum(r.length for r in rows)
    assert ids / (2048 * len({r.sequence_id for r in rows})) > 0.97


def test_empty_null_and_repeated(docs, spark):
    assert op.pack_documents(docs([])).count() == 0
    rows = op.pack_documents(docs([(None, None), (1, "a b"), (1, "a b")])).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows) == [("1", 3), ("1", 3), ("None", 1)]
