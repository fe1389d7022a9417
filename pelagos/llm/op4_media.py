"""Media columns: progressive JPEG.

A payload of bytes is stored without loss as quantised DCT coefficients of a progressive
4:2:0 JPEG: byte b is the AC coefficient 256 + b, so each coefficient has the same size and
one Huffman code of one bit serves a scan. Two spectral bands come in two approximations
each (Al = 1, then the last bit). Reading a file accumulates its scans into coefficient
arrays, inverse-transforms them in numpy, upsamples chroma and gives a full-resolution RGB
tensor, which the result stores beside the media column. The reader takes any progressive JPEG with 8-bit samples and without restarts; scans
whose codes have one length are read as arrays, others bit by bit.

Defined results: a null text is empty, its payload 64 zero bytes; a null doc_id stays null;
repeated rows give equal values; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pelagos.llm import bytehash as bh
from pelagos.session import long_rows, table

NAME = "op4_progressive_jpeg"
PAD, PER_BLOCK, BANDS, ROWS, SLICE, BYTES = 64, 63, ((1, 5), (6, 63)), 256, 4096, 8 << 20
FACTORS = ((1, 2, 2), (2, 1, 1), (3, 1, 1))  # component, horizontal and vertical sampling
MEDIA = "doc_id long, n_bytes long, media binary"
READ = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, media binary, height int, width int, rgb binary"


def payload(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes(-len(raw) % PAD or (0 if raw else PAD))


@cache
def zigzag() -> np.ndarray:
    """Row-major place of each zigzag index."""
    return np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, p // 8 if (p // 8 + p % 8) % 2 else p % 8)))


@cache
def inverse() -> np.ndarray:
    """64 x 64: coefficients in zigzag order to samples in row-major order."""
    k = np.arange(8)
    c = np.cos((2 * k[None] + 1) * k[:, None] * np.pi / 16) * np.where(k == 0, np.sqrt(1 / 8), 0.5)[:, None]
    return np.kron(c, c)[zigzag()].astype(np.float32)


# ---- writing


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 255, marker, len(body) + 2) + body


def _table(kind: int, at: int, symbol: int) -> bytes:
    """A Huffman table with one code of one bit."""
    return _segment(0xC4, bytes([kind << 4 | at, 1, *[0] * 15, symbol]))


def _scan(parts, ss: int, se: int, ah: int, al: int, pieces: Iterable[np.ndarray]) -> bytes:
    """pieces: bits; all but the last fill whole bytes."""
    out = [_segment(0xDA, bytes([len(parts)]) + bytes(x for c, t in parts for x in (c, t)) + bytes([ss, se, ah << 4 | al]))]
    for bits in pieces:
        fill = -len(bits) % 8
        data = np.packbits(np.concatenate([bits, np.ones(fill, np.uint8)]) if fill else bits).tobytes()
        out.append(data.replace(b"\xff", b"\xff\x00"))
    return b"".join(out)


def _first(v: np.ndarray, a: int, b: int) -> Iterator[np.ndarray]:
    for at in range(0, len(v), SLICE):
        part = v[at:at + SLICE, a - 1:b]
        bits = np.zeros((*part.shape, 9), np.uint8)
        bits[:, :, 1:] = np.unpackbits((part >> 1 | 128)[:, :, None], axis=2)
        yield bits.reshape(-1)


def _last(v: np.ndarray, a: int, b: int) -> Iterator[np.ndarray]:
    for at in range(0, len(v), SLICE):
        part = v[at:at + SLICE, a - 1:b]
        bits = np.zeros((len(part), b - a + 2), np.uint8)
        bits[:, 1:] = part & 1
        yield bits.reshape(-1)


@cache
def _tables() -> bytes:
    return (_segment(0xDB, bytes([0, *[1] * 64])) + _table(0, 0, 0) + _table(1, 0, 8) + _table(1, 1, 0))


def encode(n: int, data: bytes) -> bytes:
    """n is the length before padding; it goes into a comment with the payload's length."""
    blocks = -(-len(data) // PER_BLOCK)
    k = -(-blocks // 6)
    mw = min(k, max(64, -(-k // 4000)))
    mh = -(-k // mw)
    k = mw * mh
    values = np.zeros(k * 6 * PER_BLOCK, np.uint8)
    values[:len(data)] = np.frombuffer(data, np.uint8)
    values = values.reshape(-1, PER_BLOCK)
    out = [b"\xff\xd8", _segment(0xFE, f"payload {len(data)} of {n}".encode()), _tables(),
           _segment(0xC2, struct.pack(">BHHB", 8, mh * 16, mw * 16, 3) + b"".join(bytes([c, h << 4 | v, 0]) for c, h, v in FACTORS)),
           _scan([(1, 0), (2, 0), (3, 0)], 0, 0, 0, 1, [np.zeros(k * 6, np.uint8)])]
    planes = [(1, values[:4 * k]), (2, values[4 * k:5 * k]), (3, values[5 * k:])]
    out += [_scan([(c, 0)], a, b, 0, 1, _first(v, a, b)) for c, v in planes for a, b in BANDS]
    out += [_scan([(c, 1)], a, b, 1, 0, _last(v, a, b)) for c, v in planes for a, b in BANDS]
    out.append(_scan([(1, 0), (2, 0), (3, 0)], 0, 0, 1, 0, [np.zeros(k * 6, np.uint8)]))
    return b"".join([*out, b"\xff\xd9"])


# ---- reading


class _Bits:
    """Bit by bit, for tables with several codes."""

    def __init__(self, bits: np.ndarray):
        self.b, self.at = bits.tolist(), 0

    def take(self, n: int = 1) -> int:
        v = 0
        for x in self.b[self.at:self.at + n]:
            v = v * 2 + x
        self.at += n
        return v

    def symbol(self, codes: dict) -> int:
        code = 1
        while code < 1 << 17:
            code = code * 2 + self.take()
            if code in codes:
                return codes[code]
        raise ValueError("no such code")

    def signed(self, size: int) -> int:
        v = self.take(size) if size else 0
        return v if not size or v >> (size - 1) else v - (1 << size) + 1


def _dc_first(bits, codes, owner, planes, order, al, fast):
    """Differences of size 0 with the code 0 are skipped in runs."""
    n, diffs = len(owner), np.zeros(len(owner), np.int32)
    if fast and codes == {2: 0} and not bits[:n].any():
        pass
    else:
        r = _Bits(bits)
        for i in range(n):
            diffs[i] = r.signed(r.symbol(codes[owner[i]] if isinstance(codes, list) else codes))
    for c, plane in planes.items():
        mine = owner == c
        plane[order[mine], 0] = np.cumsum(diffs[mine]) << al


def _ac_first(bits, codes, plane, ss, se, al, fast):
    one = next(iter(codes.values())) if len(codes) == 1 and 2 in codes else 0
    width = se - ss + 1
    if fast and 0 < one <= 8 and len(bits) >= (need := len(plane) * width * (one + 1)):
        v = np.packbits(bits[:need].reshape(-1, one + 1)[:, 1:], axis=1)[:, 0].astype(np.int32) >> (8 - one)
        v = np.where(v >> (one - 1), v, v - (1 << one) + 1)
        plane[:, ss:se + 1] = (v << al).reshape(-1, width) if (v >= 0).all() else (np.sign(v) * (abs(v) << al)).reshape(-1, width)
        return
    r, run = _Bits(bits), 0
    for block in plane:
        if run:
            run -= 1
            continue
        k = ss
        while k <= se:
            s = r.symbol(codes)
            zeros, size = s >> 4, s & 15
            if size:
                k += zeros
                v = r.signed(size)
                block[k] = v << al if v >= 0 else -(-v << al)
                k += 1
            elif zeros == 15:
                k += 16
            else:
                run = (1 << zeros) - 1 + (r.take(zeros) if zeros else 0)
                break


def _ac_refine(bits, codes, plane, ss, se, al, fast):
    width = se - ss + 1
    band = plane[:, ss:se + 1]
    if fast and codes == {2: 0} and len(bits) >= (need := len(plane) * (width + 1)) and band.all():
        step = bits[:need].reshape(-1, width + 1)[:, 1:].astype(np.int32) << al
        plane[:, ss:se + 1] = band + step if (band > 0).all() else band + np.sign(band) * step
        return
    r, run = _Bits(bits), 0

    def correct(block, k):
        if r.take():
            block[k] += (1 << al) if block[k] > 0 else -(1 << al)

    for block in plane:
        k = ss
        while k <= se and not run:
            s = r.symbol(codes)
            zeros, size = s >> 4, s & 15
            new = 0
            if size:
                new = (1 << al) if r.take() else -(1 << al)
            elif zeros < 15:
                run = (1 << zeros) + (r.take(zeros) if zeros else 0)
                break
            while k <= se:
                if block[k]:
                    correct(block, k)
                elif zeros:
                    zeros -= 1
                else:
                    block[k] = new
                    k += 1
                    break
                k += 1
        if run:
            for j in range(k, se + 1):
                if block[j]:
                    correct(block, j)
            run -= 1


def coefficients(data: bytes, fast: bool = True) -> dict:
    """Accumulates the scans: {planes: {component: (blocks, 64)}, grid, factors, quant, size, comment}."""
    at, quant, huff, comment, got = 2, {}, {}, b"", None
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    while data[at + 1] != 0xD9:
        marker, (length,) = data[at + 1], struct.unpack_from(">H", data, at + 2)
        body = data[at + 4:at + 2 + length]
        at += 2 + length
        if marker == 0xFE:
            comment = body
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = np.frombuffer(body[1:65 + 64 * wide], ">u2" if wide else "u1").astype(np.float32)
                body = body[65 + 64 * wide:]
        elif marker == 0xC4:
            while body:
                counts, codes, code, i = body[1:17], {}, 0, 17
                for bits, n in enumerate(counts, 1):
                    for _ in range(n):
                        codes[1 << bits | code] = body[i]
                        code, i = code + 1, i + 1
                    code *= 2
                huff[body[0]] = codes
                body = body[i:]
        elif marker == 0xC2:
            _, h, w, n = struct.unpack_from(">BHHB", body)
            comps = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            hm, vm = max(c[1] for c in comps), max(c[2] for c in comps)
            mw, mh = -(-w // (8 * hm)), -(-h // (8 * vm))
            got = {"planes": {c: np.zeros((mw * ch * mh * cv, 64), np.int32) for c, ch, cv, _ in comps}, "grid": {c: (mh * cv, mw * ch) for c, ch, cv, _ in comps}, "quant": {c: q for c, _, _, q in comps},
                   "own": {c: (-(-(-(-h * cv // vm)) // 8), -(-(-(-w * ch // hm)) // 8)) for c, ch, cv, _ in comps}, "factors": {c: (cv, ch) for c, ch, cv, _ in comps}, "mcus": (mh, mw), "size": (h, w)}
        elif marker == 0xDD and body != b"\0\0":
            raise ValueError("restart intervals are not read")
        elif marker == 0xDA:
            n = body[0]
            parts = [(body[1 + 2 * i], body[2 + 2 * i]) for i in range(n)]
            ss, se, ah, al = body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15
            end = at
            while True:
                end = data.index(b"\xff", end)
                if data[end + 1]:
                    break
                end += 2
            bits = np.unpackbits(np.frombuffer(data[at:end].replace(b"\xff\x00", b"\xff"), np.uint8))
            at = end
            _accumulate(got, huff, parts, ss, se, ah, al, bits, fast)
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("only progressive JPEG is read")
    return got | {"tables": quant, "comment": comment}


def _accumulate(got, huff, parts, ss, se, ah, al, bits, fast) -> None:
    def single(c):
        (oh, ow), (_, gw) = got["own"][c], got["grid"][c]
        return None if (oh, ow) == got["grid"][c] else (np.arange(oh)[:, None] * gw + np.arange(ow)).reshape(-1)

    if ss:
        (c, t), = parts
        plane, part = got["planes"][c], single(c)
        view = plane if part is None else plane[part]
        (_ac_refine if ah else _ac_first)(bits, huff[16 + (t & 15)], view, ss, se, al, fast)
        if part is not None:
            plane[part] = view
        return
    if len(parts) == 1:
        c = parts[0][0]
        order = single(c)
        order = np.arange(len(got["planes"][c])) if order is None else order
        owner = np.full(len(order), c)
    else:
        mh, mw = got["mcus"]
        places, owners = [], []
        for c, _ in parts:
            cv, ch = got["factors"][c]
            y, x, v, h = np.ix_(np.arange(mh), np.arange(mw), np.arange(cv), np.arange(ch))
            places.append(((y * cv + v) * (mw * ch) + x * ch + h).reshape(mh * mw, -1))
            owners.append(np.full(places[-1].shape, c))
        order, owner = np.concatenate(places, 1).reshape(-1), np.concatenate(owners, 1).reshape(-1)
    planes = {c: got["planes"][c] for c, _ in parts}
    if ah:
        for c, plane in planes.items():
            mine = owner == c
            plane[order[mine], 0] |= bits[:len(owner)][mine].astype(np.int32) << al
    else:
        codes = [huff[t >> 4] for _, t in parts]
        same = all(x == codes[0] for x in codes)
        _dc_first(bits, codes[0] if same else {c: huff[t >> 4] for c, t in parts}, owner, planes, order, al, fast and same) if same else _dc_mixed(bits, {c: huff[t >> 4] for c, t in parts}, owner, planes, order, al)


def _dc_mixed(bits, codes, owner, planes, order, al) -> None:
    r, diffs = _Bits(bits), np.zeros(len(owner), np.int32)
    for i, c in enumerate(owner.tolist()):
        diffs[i] = r.signed(r.symbol(codes[c]))
    for c, plane in planes.items():
        mine = owner == c
        plane[order[mine], 0] = np.cumsum(diffs[mine]) << al


def rgb(got: dict) -> np.ndarray:
    """(height, width, 3) of uint8."""
    h, w = got["size"]
    up = []
    for c, plane in got["planes"].items():
        gh, gw = got["grid"][c]
        s = plane.astype(np.float32) @ (inverse() * got["tables"][got["quant"][c]][:, None])
        s = s.reshape(gh, gw, 8, 8).swapaxes(1, 2).reshape(gh * 8, gw * 8) + np.float32(128)
        cv, ch = got["factors"][c]
        vm, hm = (max(f[i] for f in got["factors"].values()) for i in (0, 1))
        np.clip(s, 0, 255, out=s)
        up.append(np.repeat(np.repeat(s, vm // cv, 0), hm // ch, 1)[:h, :w])
    if len(up) == 1:
        up *= 3
    else:
        y, cb, cr = up[0], up[1] - np.float32(128), up[2] - np.float32(128)
        up = [y + np.float32(1.402) * cr, y - np.float32(0.344136) * cb - np.float32(0.714136) * cr, y + np.float32(1.772) * cb]
    out = np.empty((h, w, 3), np.uint8)
    for i, x in enumerate(up):
        np.rint(x, out=x)
        out[:, :, i] = np.clip(x, 0, 255, out=x)
    return out


def restore(got: dict) -> tuple[int, bytes]:
    """The unpadded length and the payload behind encode()."""
    _, size, _, n = got["comment"].split()
    values = np.concatenate([p[:, 1:] for p in got["planes"].values()]).astype(np.uint8).tobytes()
    return int(n), values[:int(size)]


def feature(tensor: np.ndarray) -> str:
    """Size, mean of each channel and of each quarter's green, and the tensor's checksum."""
    h, w, _ = tensor.shape
    px = h * w
    means = tensor.reshape(px, 3).sum(0, dtype=np.int64)
    quarters = [tensor[a, b, 1].sum(dtype=np.int64) * 4 for a in (slice(h // 2), slice(h // 2, h)) for b in (slice(w // 2), slice(w // 2, w))]
    return f"{h}x{w};" + ",".join(f"{int(x) * 1000 // px}" for x in (*means, *quarters)) + f";{zlib.crc32(tensor.tobytes()):08x}"


# ---- columns


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = ROWS) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, bytes))
        if len(held) == most or size >= BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the stored form of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def task(batches):
        def rows():
            for b in batches:
                for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                    n, data = payload(text.as_py())
                    yield doc, n, encode(n, data)
        yield from _batches(rows(), schema)

    return long_rows(docs).selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(bh.lean(task), MEDIA)


def tensors(media: DataFrame) -> DataFrame:
    """doc_id, height, width and the RGB tensor (row-major bytes) of every stored form."""
    schema = pa.schema([("doc_id", pa.int64()), ("height", pa.int32()), ("width", pa.int32()), ("rgb", pa.binary())])

    def task(batches):
        def rows():
            for b in batches:
                for doc, data in zip(b.column(0).to_pylist(), b.column(1)):
                    t = rgb(coefficients(data.as_py()))
                    yield doc, t.shape[0], t.shape[1], t.tobytes()
        yield from _batches(rows(), schema, 32)

    return media.select("doc_id", "media").mapInArrow(bh.lean(task), "doc_id long, height int, width int, rgb binary")


def read_back(media: DataFrame) -> DataFrame:
    """What the stored bytes give: digests of payload and stored form, features, and the media
    column itself with its full-resolution RGB tensor (row-major bytes, height x width x 3)."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in READ.split(", ")])

    def task(batches):
        def rows():
            for b in batches:
                for doc, data in zip(b.column(0).to_pylist(), b.column(2)):
                    data = data.as_py()
                    got = coefficients(data)
                    n, back = restore(got)
                    t = rgb(got)
                    yield (doc, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-PAD:]), len(data), hashlib.sha256(data).hexdigest(), feature(t), data, t.shape[0], t.shape[1], t.tobytes())
        yield from _batches(rows(), schema)

    return media.mapInArrow(bh.lean(task), READ)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(store(table(spark, sf_dir, "documents")))


ORACLE_SQL = None  # an exact round trip is tested
