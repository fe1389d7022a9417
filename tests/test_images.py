import struct
import zlib

import numpy as np
import pytest

from pelagos.operators import enhance, projections
from pelagos.sources import images


def tiled(a, side, order=">", big=False):
    """bands x h x w as a tiled TIFF, interleaved, deflate with differences, written by hand."""
    b, h, w = a.shape
    blocks = []
    for r in range(0, h, side):
        for c in range(0, w, side):
            t = np.zeros((side, side, b), a.dtype)
            part = a[:, r:r + side, c:c + side].transpose(1, 2, 0)
            t[:part.shape[0], :part.shape[1]] = part
            d = t.copy()
            d[:, 1:] -= t[:, :-1]
            blocks.append(zlib.compress(d.astype(a.dtype.newbyteorder(order)).tobytes()))
    n = len(blocks)
    word, head = ("Q", 16) if big else ("I", 8)
    tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [16] * b), (259, 3, [8]), (277, 3, [b]), (317, 3, [2]), (322, 3, [side]), (323, 3, [side]), (324, 16 if big else 4, None), (325, 4, [len(x) for x in blocks]), (339, 3, [1] * b)]
    code = {3: "H", 4: "I", 16: "Q"}
    fit, step = (8, 20) if big else (4, 12)
    at = head + (8 if big else 2) + step * len(tags) + (8 if big else 4)
    sizes = [struct.calcsize(order + code[k] * (len(v) if v else n)) for _, k, v in tags]
    start = at + sum(s for s in sizes if s > fit)
    offsets = [start + sum(len(x) for x in blocks[:i]) for i in range(n)]
    mark = b"MM" if order == ">" else b"II"
    out = struct.pack(order + "2sHHHQ", mark, 43, 8, 0, 16) if big else struct.pack(order + "2sHI", mark, 42, 8)
    out += struct.pack(order + ("Q" if big else "H"), len(tags))
    extra = b""
    for tag, kind, values in tags:
        raw = struct.pack(order + code[kind] * (len(values) if values else n), *(values or offsets))
        out += struct.pack(order + "HH" + word, tag, kind, len(values) if values else n)
        out += raw.ljust(fit, b"\0") if len(raw) <= fit else struct.pack(order + word, at + len(extra))
        extra += raw if len(raw) > fit else b""
    return out + bytes(8 if big else 4) + extra + b"".join(blocks)


def image(spark, path, **kw):
    rows = images.read_tiles(spark, [path], **kw).collect()
    lo = [min(r.row for r in rows), min(r.col for r in rows)]
    hi = [max(r.row + r.height for r in rows), max(r.col + r.width for r in rows)]
    out = np.full((1 + max(r.band for r in rows), hi[0] - lo[0], hi[1] - lo[1]), -1.0)
    for r in rows:
        out[r.band, r.row - lo[0]:r.row - lo[0] + r.height, r.col - lo[1]:r.col - lo[1] + r.width] = np.frombuffer(r.payload, "<f4").reshape(r.height, r.width)
    return out, lo


@pytest.mark.parametrize("order,big", [(">", False), ("<", False), ("<", True)])
def test_tiled_tiff(spark, tmp_path, order, big):
    a = np.random.default_rng(1).integers(0, 60_000, (2, 70, 45)).astype(np.uint16)
    (tmp_path / "a.tif").write_bytes(tiled(a, 16, order, big))
    got, lo = image(spark, str(tmp_path / "a.tif"))
    assert lo == [0, 0] and (got == a).all()
    got, lo = image(spark, str(tmp_path / "a.tif"), window=(30, 10, 21, 9))
    assert lo == [30, 10] and (got == a[:, 30:51, 10:19]).all()


@pytest.mark.parametrize("kind", ["u1", "i2", "f4", "f8"])
def test_geotiff_round_trip(spark, tmp_path, kind):
    a = np.random.default_rng(2).integers(-100 if kind[0] != "u" else 0, 120, (3, 20, 31)).astype(kind)
    path = str(tmp_path / "b.tif")
    (tmp_path / "b.tif").write_bytes(images.tiff(a, [-76.5, 0.001, 0, 37.0, 0, -0.002], 4326, deflate=kind != "f8"))
    got, _ = image(spark, path, bands=[0, 2])
    assert (got[[0, 2]] == a[[0, 2]]).all() and (got[1] == -1).all()
    m = images.read_metadata(spark, [path]).first()
    assert (m.width, m.height, m.bands, m.dtype, m.epsg) == (31, 20, 3, kind, 4326) and np.allclose(m.transform, [-76.5, 0.001, 0, 37.0, 0, -0.002])
    assert np.allclose((m.min_x, m.min_y, m.max_x, m.max_y), (-76.5, 36.96, -76.469, 37.0))


def test_what_is_not_read(tmp_path):
    raw = images.tiff(np.zeros((1, 4, 4), np.uint8))
    assert images.sound(raw) and not images.sound(raw[:-3]) and not images.sound(b"II*\0") and not images.sound(b"")
    (tmp_path / "c.tif").write_bytes(raw.replace(struct.pack("<HHIHH", 259, 3, 1, 8, 0), struct.pack("<HHIHH", 259, 3, 1, 5, 0)))
    with pytest.raises(ValueError, match="compression 5"):
        list(images.tiff_blocks(str(tmp_path / "c.tif")))


@pytest.mark.parametrize("shape,kind", [((7, 5), "u1"), ((6, 9, 3), "u1"), ((4, 4, 4), "u2"), ((1, 1, 2), "u1")])
def test_png(shape, kind):
    a = np.random.default_rng(3).integers(0, 256, shape).astype(kind)
    raw = images.png(a)
    assert (images.read_png(raw) == a.reshape(*shape[:2], -1)).all() and images.sound(raw) and not images.sound(raw[:-20])


def test_png_filters():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 256, (10, 8, 3)).astype(np.uint8)
    lines, above = [], np.zeros(24, int)
    for i, row in enumerate(a.reshape(10, -1).astype(int)):
        left, corner = np.r_[0, 0, 0, row[:-3]], np.r_[0, 0, 0, above[:-3]]
        p = left + above - corner
        d = np.stack([abs(p - left), abs(p - above), abs(p - corner)]).argmin(0)
        guess = [0 * row, left, above, (left + above) // 2, np.choose(d, [left, above, corner])][i % 5]
        lines.append(bytes([i % 5]) + ((row - guess) % 256).astype(np.uint8).tobytes())
        above = row
    raw = images.png(a)
    body = zlib.compress(b"".join(lines))
    at = raw.index(b"IDAT")
    raw = raw[:at - 4] + struct.pack(">I", len(body)) + b"IDAT" + body + struct.pack(">I", zlib.crc32(b"IDAT" + body)) + raw[-12:]
    assert (images.read_png(raw) == a).all()


def test_crops(spark, tmp_path):
    a = np.random.default_rng(5).integers(0, 256, (1, 100, 90)).astype(np.uint8)
    (tmp_path / "d.tif").write_bytes(tiled(a.astype(np.uint16), 32))
    tiles = images.read_tiles(spark, [str(tmp_path / "d.tif")])
    points = spark.createDataFrame([(1, 50, 40), (2, 3, 88), (3, 500, 500)], "id long, row int, col int")
    got = {r.id: images.read_png(bytes(r.png))[:, :, 0] for r in images.crops(points, tiles, 20, 32).collect()}
    big = np.pad(a[0], 20)
    assert (got[1] == a[0, 40:60, 30:50]).all() and (got[2] == big[13:33, 98:118]).all() and not got[3].any()
    assert (np.load(__import__("io").BytesIO(images.npy(a))) == a).all()


def test_enhancement():
    rng = np.random.default_rng(6)
    dull = rng.integers(100, 120, (1, 64, 64)).astype(np.uint8)
    out = enhance.enhance(dull)
    assert out.dtype == np.uint8 and out.std() > 2 * dull.std() and enhance.clahe(np.full((40, 50), 9, np.uint8)).std() == 0
    step = np.zeros((1, 20, 20), np.uint8) + 50
    step[:, :, 10:] = 150
    sharp = enhance.enhance(step, "sentinel2")[0].astype(int)
    assert sharp[10, 9] < 50 and sharp[10, 10] > 150 and (sharp[:, 0] == 50).all()
    noisy = np.clip(step[0] + rng.normal(0, 8, (20, 20)), 0, 255).astype(np.uint8)
    calm = enhance.speckle(noisy[None])[0].astype(float)
    assert calm[:, :6].std() < 0.6 * noisy[:, :6].std() and abs(calm[:, 15].mean() - 150) < 12
    assert enhance.enhance(step, "landsat") is step


def test_augmentations(spark):
    rng = lambda: np.random.default_rng(1)
    a = np.random.default_rng(7).random((3, 8, 8))
    for f in enhance.AUGMENTATIONS.values():
        assert (f(a, rng(), ("vh", "vv", "vv_overlap1")) == f(a, rng(), ("vh", "vv", "vv_overlap1"))).all()
    assert set(np.round(enhance.bucket(a, rng())[0] * 10, 6).ravel()) <= set(map(float, range(10))) and (enhance.bucket(a, rng())[2] == a[2]).all()
    assert abs(enhance.small_jitter(a, rng()) - a).max() <= 0.05 + 1e-9
    hidden = [enhance.hide_overlapping(a, np.random.default_rng(i), ("vh", "vv", "vv_overlap1")) for i in range(300)]
    share = sum((h[2] != a[2]).all() for h in hidden) / 300
    assert 0.1 < share < 0.3 and all((h[:2] == a[:2]).all() for h in hidden) and {h[2, 0, 0] for h in hidden} >= {0, 255}
    t = spark.createDataFrame([(i, 3, 8, 8, a.astype("<f4").tobytes()) for i in range(5)], "id long, bands int, height int, width int, payload binary")
    one, two = (enhance.over_tiles(t, ["Noise", "Jitter2"], ("vh", "vv", "x"), 3).orderBy("id").collect() for _ in (0, 1))
    assert one == two and len({bytes(r.payload) for r in one}) == 5


def test_label_targets(spark):
    p = '{"Length":85,"Width":17,"Heading":71,"ShipAndCargoType":30,"Speed":0.4}'
    df = spark.createDataFrame([(1, p), (2, p.replace("30", "70").replace("85", "20"))], "id long, properties string")
    a, b = (r.target for r in df.select(projections.custom_target("properties").alias("target")).collect())
    want = [0.85, 0.17] + [0.0] * 16 + [0.4, 0.0, 1.0]
    for k, w in ((3, 8 / 14), (2, 1 / 14), (4, 1 / 14), (11, 2 / 14), (10, 1 / 14), (12, 1 / 14)):
        want[2 + k] = w
    assert len(a) == 21 and np.allclose(a[:2] + a[18:], want[:2] + want[18:]) and abs(a[2 + 3] - 8 / 14) < 1e-6 and abs(a[2 + 11] - 2 / 14) < 1e-6
    assert b[0] == 0.2 and b[19:] == [1.0, 0.0]
    values = spark.createDataFrame([(1, 5.0), (1, 7.0), (2, None)], "window_id long, value double")
    assert {r.window_id: r.target for r in projections.regression_target(values).collect()} == {1: 5.0, 2: 0.0}
