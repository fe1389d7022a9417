"""Image files: GeoTIFF by byte ranges, PNG, .npy, and the integrity of image files.

A GeoTIFF's header and its blocks (strips or tiles) are tables; only the blocks that a window
touches are read, each by its own byte range, so a file of any size spreads over tasks. Paths
are opened by pyarrow's file systems (local, HDFS, object stores).

Read: classic and big TIFF, 8 to 64 bits a sample, uncompressed or deflate, without predictor
or with differences of whole numbers, bands interleaved or apart. PNG: 8 or 16 bits, grey, RGB,
with alpha, not interlaced.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

META = "path string, width long, height long, bands int, dtype string, transform array<double>, epsg int, nodata double, min_x double, min_y double, max_x double, max_y double"
BLOCK = "path string, offset long, size long, row long, col long, height int, width int, band int, samples int, dtype string, deflate boolean, differences boolean"
TILE = "path string, band int, row long, col long, height int, width int, payload binary"
#: TIFF field types (struct code) and tags.
KINDS = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
TAGS = {256: "width", 257: "height", 258: "bits", 259: "compression", 273: "offsets", 277: "bands", 278: "rows", 279: "sizes", 284: "planar", 317: "predictor", 322: "tile_w", 323: "tile_h", 324: "offsets", 325: "sizes", 339: "format", 33550: "scale", 33922: "tie", 34264: "matrix", 34735: "geokeys", 42113: "nodata"}


def _open(path: str):
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    system, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(at)


def tiff_header(file) -> dict:
    """The first directory's fields by name, and `order`."""
    head = file.read_at(16, 0)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack(order + "H", head[2:4])[0] if order else 0
    if version not in (42, 43):
        raise ValueError("no TIFF")
    big = version == 43
    at, = struct.unpack(order + "Q", head[8:16]) if big else struct.unpack(order + "I", head[4:8])
    n, = struct.unpack(order + ("Q" if big else "H"), file.read_at(8 if big else 2, at))
    step, at = (20, at + 8) if big else (12, at + 2)
    raw, out = file.read_at(n * step, at), {"order": order}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + ("HHQ" if big else "HHI"), raw, i * step)
        if tag not in TAGS or kind not in KINDS:
            continue
        code = f"{count}s" if kind == 2 else KINDS[kind] * count
        size, place = struct.calcsize(order + code), i * step + (12 if big else 8)
        data = raw[place:place + size] if size <= (8 if big else 4) else file.read_at(size, struct.unpack_from(order + ("Q" if big else "I"), raw, place)[0])
        out[TAGS[tag]] = struct.unpack(order + code, data)
    return out


def _dtype(h: dict) -> str:
    return h["order"] + {1: "u", 2: "i", 3: "f"}[h.get("format", (1,))[0]] + str(h.get("bits", (1,))[0] // 8)


def _transform(h: dict) -> list[float] | None:
    """GDAL order: x origin, pixel width, row rotation, y origin, column rotation, pixel height."""
    if "matrix" in h:
        m = h["matrix"]
        return [m[3], m[0], m[1], m[7], m[4], m[5]]
    if "scale" in h and "tie" in h:
        (sx, sy, *_), (i, j, _, x, y, *_) = h["scale"], h["tie"]
        return [x - i * sx, sx, 0.0, y + j * sy, 0.0, -sy]
    return None


def tiff_metadata(path: str) -> tuple:
    """A row of META."""
    with _open(path) as file:
        h = tiff_header(file)
    w, n, t = h["width"][0], h["height"][0], _transform(h)
    keys = h.get("geokeys", ())
    epsg = next((v for k, place, _, v in zip(*[iter(keys)] * 4) if k in (2048, 3072) and not place), None)
    nodata = float(h["nodata"][0].rstrip(b"\0 ") or b"nan") if "nodata" in h else None
    xs = [t[0] + c * t[1] + r * t[2] for c in (0, w) for r in (0, n)] if t else [None]
    ys = [t[3] + c * t[4] + r * t[5] for c in (0, w) for r in (0, n)] if t else [None]
    return path, w, n, h.get("bands", (1,))[0], _dtype(h)[1:], t, epsg, nodata, min(xs), min(ys), max(xs), max(ys)


def tiff_blocks(path: str) -> Iterator[tuple]:
    """Rows of BLOCK: where each strip or tile lies in the file and in the image."""
    with _open(path) as file:
        h = tiff_header(file)
    if (packed := h.get("compression", (1,))[0]) not in (1, 8, 32946):
        raise ValueError(f"TIFF compression {packed} isn't read")
    if (predictor := h.get("predictor", (1,))[0]) not in (1, 2):
        raise ValueError(f"TIFF predictor {predictor} isn't read")
    w, n, bands = h["width"][0], h["height"][0], h.get("bands", (1,))[0]
    tw, th = (h["tile_w"][0], h["tile_h"][0]) if "tile_w" in h else (w, min(h.get("rows", (n,))[0], n))
    across, down = -(-w // tw), -(-n // th)
    apart = h.get("planar", (1,))[0] == 2
    for i, (offset, size) in enumerate(zip(h["offsets"], h["sizes"])):
        band, at = divmod(i, across * down)
        row = at // across * th
        yield path, offset, size, row, at % across * tw, th if "tile_w" in h else min(th, n - row), tw, band, 1 if apart else bands, _dtype(h), packed != 1, predictor == 2


def _block(row: dict, file) -> np.ndarray:
    """samples x height x width."""
    raw = file.read_at(row["size"], row["offset"])
    if row["deflate"]:
        raw = zlib.decompress(raw)
    a = np.frombuffer(raw, row["dtype"], row["height"] * row["width"] * row["samples"]).reshape(row["height"], row["width"], row["samples"])
    if row["differences"]:
        a = np.cumsum(a, axis=1, dtype=a.dtype.newbyteorder("="))
    return a.transpose(2, 0, 1)


def _rows(schema: str, rows) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    names, types = zip(*(f.split() for f in schema.split(", ")))
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(cols, types)], names=list(names))


def read_metadata(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Size, bands, type, transform, EPSG code, no-data value and bounds of each GeoTIFF."""
    def task(batches):
        for b in batches:
            yield _rows(META, [tiff_metadata(p) for p in b.column(0).to_pylist()])
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths))).mapInArrow(task, META)


def read_tiles(spark: SparkSession, paths: list[str], window: tuple[int, int, int, int] | None = None, bands: list[int] | None = None) -> DataFrame:
    """The blocks of the GeoTIFFs as float32 tiles (path, band from 0, row, col, height, width,
    payload), or the parts of those that a window (row, col, height, width) touches."""
    def blocks(batches):
        for b in batches:
            for p in b.column(0).to_pylist():
                yield _rows(BLOCK, list(tiff_blocks(p)))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["path"]) as file:
                    a = _block(row, file)
                r, c = row["row"], row["col"]
                lo_r, lo_c, hi_r, hi_c = 0, 0, min(a.shape[1], row["whole_h"] - r), min(a.shape[2], row["whole_w"] - c)
                if window:
                    lo_r, lo_c = max(lo_r, window[0] - r), max(lo_c, window[1] - c)
                    hi_r, hi_c = min(hi_r, window[0] + window[2] - r), min(hi_c, window[1] + window[3] - c)
                part = a[:, lo_r:hi_r, lo_c:hi_c]
                yield _rows(TILE, [(row["path"], row["band"] + k, r + lo_r, c + lo_c, part.shape[1], part.shape[2], part[k].astype("<f4").tobytes()) for k in range(len(part)) if bands is None or row["band"] + k in bands])

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    size = read_metadata(spark, paths).select("path", F.col("height").alias("whole_h"), F.col("width").alias("whole_w"))
    found = files.mapInArrow(blocks, BLOCK).join(F.broadcast(size), "path")  # a row for each path given
    if window:
        found = found.filter((F.col("row") < window[0] + window[2]) & (F.col("row") + F.col("height") > window[0]) & (F.col("col") < window[1] + window[3]) & (F.col("col") + F.col("width") > window[1]))
    return found.repartition("path", "offset").mapInArrow(read, TILE)


def tiff(a: np.ndarray, transform: list[float] | None = None, epsg: int | None = None, deflate: bool = True) -> bytes:
    """bands x height x width as a GeoTIFF of one strip a band."""
    a = np.ascontiguousarray(a[None] if a.ndim == 2 else a)
    a = a.astype(a.dtype.newbyteorder("<"))
    strips = [zlib.compress(x.tobytes()) if deflate else x.tobytes() for x in a]
    fields = [(256, "I", [a.shape[2]]), (257, "I", [a.shape[1]]), (258, "H", [a.itemsize * 8] * len(a)), (259, "H", [8 if deflate else 1]), (262, "H", [1]), (273, "I", None), (277, "H", [len(a)]), (278, "I", [a.shape[1]]), (279, "I", [len(s) for s in strips]), (284, "H", [2]), (339, "H", [{"u": 1, "i": 2, "f": 3}[a.dtype.kind]] * len(a))]
    if transform:
        x, sx, _, y, _, sy = transform
        fields += [(33550, "d", [sx, -sy, 0.0]), (33922, "d", [0.0, 0.0, 0.0, x, y, 0.0])]
    if epsg:
        fields.append((34735, "H", [1, 1, 0, 1, 2048, 0, 1, epsg]))
    at = 8 + 2 + 12 * len(fields) + 4
    extra, starts = b"", []
    data_at = at + sum((n + 1 & ~1) for n in (struct.calcsize("<" + c * len(v or strips)) for _, c, v in fields) if n > 4)
    for s in strips:
        starts.append(data_at)
        data_at += len(s)
    out = struct.pack("<2sHIH", b"II", 42, 8, len(fields))
    for tag, code, values in sorted(fields, key=lambda f: f[0]):
        values = starts if values is None else values
        raw = struct.pack("<" + code * len(values), *values)
        kind = {"H": 3, "I": 4, "d": 12}[code]
        if len(raw) <= 4:
            out += struct.pack("<HHI4s", tag, kind, len(values), raw)
        else:
            out += struct.pack("<HHII", tag, kind, len(values), at + len(extra))
            extra += raw + bytes(len(raw) % 2)
    return b"".join([out, bytes(4), extra, *strips])


# ---- PNG and .npy


def png(a: np.ndarray) -> bytes:
    """height x width [x 2, 3 or 4] of uint8 or uint16."""
    a = a[:, :, None] if a.ndim == 2 else a
    if a.dtype not in (np.uint8, np.uint16):
        raise ValueError("PNG holds 8 or 16 bits")

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    lines = np.ascontiguousarray(a.astype(a.dtype.newbyteorder(">"))).reshape(len(a), -1).view(np.uint8)
    head = struct.pack(">IIBBBBB", a.shape[1], a.shape[0], a.itemsize * 8, {1: 0, 2: 4, 3: 2, 4: 6}[a.shape[2]], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(np.concatenate([np.zeros((len(lines), 1), np.uint8), lines], 1).tobytes())) + chunk(b"IEND", b"")


def read_png(raw: bytes) -> np.ndarray:
    """height x width x channels. Sums of chunks are checked."""
    if raw[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    at, data, head, done = 8, [], None, False
    while at + 12 <= len(raw) and not done:
        n, = struct.unpack_from(">I", raw, at)
        name, body = raw[at + 4:at + 8], raw[at + 8:at + 8 + n]
        if len(body) < n or zlib.crc32(name + body) != struct.unpack_from(">I", raw, at + 8 + n)[0]:
            raise ValueError("a damaged chunk")
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif name == b"IDAT":
            data.append(body)
        done = name == b"IEND"
        at += 12 + n
    w, h, bits, colour, _, _, laced = head or (0,) * 7
    if not done or laced or bits not in (8, 16) or colour == 3:
        raise ValueError("a PNG that is cut off, interlaced, indexed or packed")
    channels, size = {0: 1, 4: 2, 2: 3, 6: 4}[colour], bits // 8
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(h, -1)
    out, step = np.zeros((h + 1, w * channels * size + channels * size), np.uint8), channels * size
    for i, (kind, *_), line in zip(range(1, h + 1), lines[:, :1].tolist(), lines[:, 1:]):
        up, now = out[i - 1], out[i]
        if kind == 0:
            now[step:] = line
        elif kind == 2:
            now[step:] = line + up[step:]
        elif kind == 1:
            for k in range(step):
                now[step + k::step] = np.cumsum(line[k::step], dtype=np.uint8)
        else:  # each byte needs the one before it
            a, b = now.tolist(), up.tolist()
            for j, x in enumerate(line.tolist(), step):
                left, above, corner = a[j - step], b[j], b[j - step]
                if kind == 3:
                    guess = (left + above) // 2
                else:
                    p = left + above - corner
                    guess = min((abs(p - left), 0, left), (abs(p - above), 1, above), (abs(p - corner), 2, corner))[2]
                a[j] = (x + guess) & 255
            now[:] = a
    return np.ascontiguousarray(out[1:, step:]).view(">u2" if size == 2 else np.uint8).reshape(h, w, channels)


def npy(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, a)
    return out.getvalue()


def sound(raw: bytes) -> bool:
    """Whether PNG, GeoTIFF or .npy bytes can be read whole."""
    try:
        if raw[:4] == b"\x89PNG":
            return read_png(raw).size > 0
        if raw[:6] == b"\x93NUMPY":
            return np.load(io.BytesIO(raw)).size > 0
        h = tiff_header(pa.BufferReader(raw))
        return all(o + n <= len(raw) for o, n in zip(h["offsets"], h["sizes"]))
    except (ValueError, KeyError, struct.error, zlib.error, OSError):
        return False


def crops(points: DataFrame, tiles: DataFrame, side: int = 120, tile: int = 512) -> DataFrame:
    """points(id, row, col) -> id and a grey PNG of side x side pixels about it from the tiles
    (row, col, height, width, payload float32 in 0..255) of one band; outside them it is black. A
    crop meets the few tiles it touches, on squares of `tile` pixels."""
    half = side // 2
    cell = lambda c: F.sequence(F.floor((F.col(c) - half) / tile), F.floor((F.col(c) + side - half - 1) / tile))
    p = points.select("id", "row", "col").withColumn("_y", F.explode(cell("row"))).withColumn("_x", F.explode(cell("col")))
    t = tiles.select(F.col("row").alias("tr"), F.col("col").alias("tc"), "height", "width", "payload")
    span = lambda a, n: F.explode(F.sequence(F.floor(F.col(a) / tile), F.floor((F.col(a) + F.col(n) - 1) / tile)))
    t = t.withColumn("_y", span("tr", "height")).withColumn("_x", span("tc", "width"))
    met = p.join(t, ["_y", "_x"], "left").drop("_y", "_x").distinct()

    def paste(rows: pa.Table) -> pa.Table:
        out, first = np.zeros((side, side), np.uint8), rows.slice(0, 1).to_pylist()[0]
        top, left = first["row"] - half, first["col"] - half
        for r in rows.to_pylist():
            if r["payload"] is None:
                continue
            a = np.frombuffer(r["payload"], "<f4").reshape(r["height"], r["width"])
            y0, x0 = max(top, r["tr"]), max(left, r["tc"])
            y1, x1 = min(top + side, r["tr"] + r["height"]), min(left + side, r["tc"] + r["width"])
            if y0 < y1 and x0 < x1:
                out[y0 - top:y1 - top, x0 - left:x1 - left] = np.clip(a[y0 - r["tr"]:y1 - r["tr"], x0 - r["tc"]:x1 - r["tc"]], 0, 255)
        return pa.table({"id": [first["id"]], "png": [png(out)]})

    return met.groupBy("id").applyInArrow(paste, "id long, png binary")
