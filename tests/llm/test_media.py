import hashlib
import zlib

import numpy as np
import pytest

from pelagos.llm import op4_media as op


@pytest.mark.parametrize("text", ["", "a", "x" * 64, "é" * 700, "\x00\xff" * 40, "word " * 9000])
def test_round_trip(text):
    n, data = op.payload(text)
    assert len(data) % 64 == 0 and data and data.startswith(text.encode()) and not any(data[n:])
    assert op.restore(op.coefficients(op.encode(n, data))) == (n, data)


def test_slow_reader_agrees():
    n, data = op.payload("The slow reader takes one bit after the other. " * 12)
    media = op.encode(n, data)
    a, b = op.coefficients(media), op.coefficients(media, fast=False)
    assert all((a["planes"][c] == b["planes"][c]).all() for c in a["planes"])


def general(coefs):
    """One 8 x 8 grey block by an ordinary progressive file: DC, AC with runs, a refinement."""
    bits = []

    def put(v, n):
        bits.extend((v >> i) & 1 for i in range(n - 1, -1, -1))

    def value(v, size):
        put(v if v > 0 else v + (1 << size) - 1, size)

    def segment(b):
        return op._scan([(1, 0)], *b, [np.array(bits, np.uint8)])

    symbols = sorted({(r << 4) | s for r in range(16) for s in range(0, 4)} | {0xF0})
    table = bytes([0x10, *[0] * 7, len(symbols), *[0] * 8, *symbols])
    dc = bytes([0x00, 0, 0, 0, 12, *[0] * 12, *range(12)])
    code = {s: i for i, s in enumerate(symbols)}
    out = [b"\xff\xd8", op._segment(0xDB, bytes([0, *[1] * 64])), op._segment(0xC4, dc), op._segment(0xC4, table), op._segment(0xC2, bytes([8, 0, 8, 0, 8, 1, 1, 0x11, 0]))]
    d = coefs[0]
    put(abs(d).bit_length(), 4)
    value(d, abs(d).bit_length())
    out.append(segment((0, 0, 0, 0)))
    bits.clear()
    run = 0
    for k in range(1, 64):
        v = int(np.sign(coefs[k]) * (abs(coefs[k]) >> 1))
        if not v:
            run += 1
            continue
        while run > 15:
            put(code[0xF0], 8)
            run -= 16
        put(code[run << 4 | abs(v).bit_length()], 8)
        value(v, abs(v).bit_length())
        run = 0
    if run:
        put(code[0], 8)
    out.append(segment((1, 63, 0, 1)))
    bits.clear()
    run, pending = 0, []
    last = max([k for k in range(1, 64) if abs(coefs[k]) == 1], default=0)
    for k in range(1, 64):
        v = coefs[k]
        if abs(v) >> 1:
            pending.append(abs(v) & 1)
            continue
        if abs(v) == 1:
            while run > 15:
                raise AssertionError("keep runs short here")
            put(code[run << 4 | 1], 8)
            put(int(v > 0), 1)
            bits.extend(pending)
            pending, run = [], 0
        else:
            run += 1
            if k > last:
                run = 0
    put(code[0], 8)
    bits.extend(pending)
    out.append(segment((1, 63, 1, 0)))
    return b"".join([*out, b"\xff\xd9"])


def test_ordinary_progressive_file():
    c = [0] * 64
    c[0], c[1], c[2], c[5], c[9], c[10], c[30] = 37, -6, 1, 5, -1, 7, 2
    got = op.coefficients(general(c))
    assert got["planes"][1][0].tolist() == c
    assert op.rgb(got).shape == (8, 8, 3)


def test_inverse_transform():
    got = {"size": (8, 8), "planes": {1: np.zeros((1, 64), np.int64)}, "grid": {1: (1, 1)}, "quant": {1: 0}, "tables": {0: np.ones(64, np.float32)}, "factors": {1: (1, 1)}}
    got["planes"][1][0, 0] = 80
    assert (op.rgb(got) == 138).all()


def test_query_and_edge_cases(docs):
    df = docs([(1, "some text"), (2, "some text"), (3, None), (None, "é" * 100), (4, "long " * 20_000)], extra=True)
    rows = op.read_back(op.store(df)).collect()
    for r in rows:
        text = {1: "some text", 2: "some text", 3: "", None: "é" * 100, 4: "long " * 20_000}[r.doc_id]
        n, data = op.payload(text)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))
    a, b = (next(r for r in rows if r.doc_id == i) for i in (1, 2))
    assert (a.media_sha256, a.feature) == (b.media_sha256, b.feature)
    assert op.read_back(op.store(docs([]))).count() == 0
    t = op.tensors(op.store(docs(["x"]))).first()
    assert len(t.rgb) == t.height * t.width * 3


def test_result_stores_media_and_tensors(docs):
    r = op.read_back(op.store(docs([(1, "some text " * 300)]))).first()
    import numpy as np
    t = np.frombuffer(r.rgb, np.uint8).reshape(r.height, r.width, 3)
    assert hashlib.sha256(r.media).hexdigest() == r.media_sha256 and op.feature(t) == r.feature
    assert (t == op.rgb(op.coefficients(bytes(r.media)))).all()


def test_long_text_is_written_in_slices(monkeypatch):
    n, data = op.payload("längere Zeilen " * 40_000)
    whole = op.encode(n, data)
    monkeypatch.setattr(op, "SLICE", 8)
    assert op.encode(n, data) == whole and op.restore(op.coefficients(whole)) == (n, data)
