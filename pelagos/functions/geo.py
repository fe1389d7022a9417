"""Geodesic and geometric column functions. All are Catalyst expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371000.0
KNOT_MS = 0.514444
MERCATOR_M = 20037508.342789244


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def haversine_m(lat1, lon1, lat2, lon2, asin: bool = False) -> Column:
    """Great-circle distance in metres, by atan2 or by asin."""
    lat1, lon1, lat2, lon2 = (F.radians(_c(v)) for v in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * (F.asin(F.sqrt(F.least(a, F.lit(1.0)))) if asin else F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, F.lit(0.0)))))


def destination(lat, lon, bearing, metres) -> tuple[Column, Column]:
    """Great-circle destination; under a metre the point stays where it is."""
    lat0, lon0, metres = _c(lat), _c(lon), F.abs(_c(metres))
    la, lo, b, d = F.radians(lat0), F.radians(lon0), F.radians(_c(bearing)), metres / EARTH_M
    s = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.sin(la) * F.cos(d) + F.cos(la) * F.sin(d) * F.cos(b)))
    lo2 = lo + F.atan2(F.sin(b) * F.sin(d) * F.cos(la), F.cos(d) - F.sin(la) * s)
    wrapped = F.pmod(lo2 + math.pi, F.lit(2 * math.pi)) - math.pi
    near = metres < 1
    return F.when(near, lat0).otherwise(F.degrees(F.asin(s))), F.when(near, lon0).otherwise(F.degrees(wrapped))


def constant_velocity(x, y, vx, vy, dt) -> tuple[Column, Column]:
    return _c(x) + _c(vx) * _c(dt), _c(y) + _c(vy) * _c(dt)


def constant_turn(x, y, v, heading_rad, omega, dt) -> tuple[Column, Column, Column]:
    """Turning motion; straight below 1e-6 rad/s."""
    x, y, v, h, w, dt = (_c(k) for k in (x, y, v, heading_rad, omega, dt))
    straight, h2 = F.abs(w) < 1e-6, h + w * dt
    r = v / F.when(straight, F.lit(1.0)).otherwise(w)
    return (F.when(straight, x + v * F.cos(h) * dt).otherwise(x + r * (F.sin(h2) - F.sin(h))),
            F.when(straight, y + v * F.sin(h) * dt).otherwise(y + r * (F.cos(h) - F.cos(h2))), F.when(straight, h).otherwise(h2))


def process_noise(q, dt) -> Column:
    """4 x 4 process noise of constant velocity for state (x, y, vx, vy)."""
    q, dt = _c(q), _c(dt)
    a, b, c, z = q * F.pow(dt, 4) / 4, q * F.pow(dt, 3) / 2, q * F.pow(dt, 2), F.lit(0.0)
    return F.array(F.array(a, z, b, z), F.array(z, a, z, b), F.array(b, z, c, z), F.array(z, b, z, c))


def iou(x1, y1, x2, y2, u1, v1, u2, v2) -> Column:
    """Intersection over union of two boxes, 0 where they only touch."""
    x1, y1, x2, y2, u1, v1, u2, v2 = (_c(k) for k in (x1, y1, x2, y2, u1, v1, u2, v2))
    w, h = F.least(x2, u2) - F.greatest(x1, u1), F.least(y2, v2) - F.greatest(y1, v1)
    inter = F.when((w > 0) & (h > 0), w * h).otherwise(0)
    union = (x2 - x1) * (y2 - y1) + (u2 - u1) * (v2 - v1) - inter
    return F.when(union > 0, inter / union).otherwise(0.0)


def vessel_kind(vtype) -> Column:
    t = _c(vtype)
    return F.when(t.between(30, 39), "fishing").when(t.between(50, 59), "special").when(t.between(70, 79), "cargo").otherwise("other")


def uncertainty_m(vtype, minutes) -> Column:
    drift = F.when(vessel_kind(vtype) == "fishing", 10.0).when(vessel_kind(vtype) == "cargo", 30.0).when(vessel_kind(vtype) == "special", 20.0).otherwise(15.0)
    return 300.0 + F.least(drift * _c(minutes), F.lit(5000.0))


def motion_noise(vtype) -> Column:
    k = vessel_kind(vtype)
    return F.when(k == "cargo", 0.5).when(k == "fishing", 2.0).when(k == "special", 1.5).otherwise(1.0)


def degrees_per_metre(lat, strict: bool = False) -> tuple[Column, Column]:
    """(lat, lon). compat takes the cosine of degrees as they are; strict of radians."""
    lat = _c(lat)
    return F.lit(1 / 111000.0), 1 / (111000.0 * F.cos(F.radians(lat) if strict else lat))


def square_bounds(lat, lon, width_m, strict: bool = False) -> dict[str, Column]:
    dlat, dlon = degrees_per_metre(lat, strict)
    half = F.coalesce(_c(width_m), F.lit(100.0)) / 2
    return {"min_lat": _c(lat) - half * dlat, "max_lat": _c(lat) + half * dlat, "min_lon": _c(lon) - half * dlon, "max_lon": _c(lon) + half * dlon}


def flat_m(lat1, lon1, lat2, lon2, scaled: bool = False) -> Column:
    dlat, dlon = _c(lat1) - _c(lat2), _c(lon1) - _c(lon2)
    return 111000.0 * F.sqrt(dlat * dlat + dlon * dlon * (F.pow(F.cos(F.radians(_c(lat1))), 2) if scaled else F.lit(1.0)))


def shore_m(lat, lon, meridians=(-75.8, -76.8)) -> Column:
    return F.least(*[F.abs(_c(lon) - m) for m in meridians]) * 111000.0 * F.cos(F.radians(_c(lat)))


def affine(g: tuple, col, row) -> tuple[Column, Column]:
    col, row = _c(col), _c(row)
    return g[0] + col * g[1] + row * g[2], g[3] + col * g[4] + row * g[5]


def geotransform(min_lon, min_lat, max_lon, max_lat, width, height) -> dict[str, Column]:
    return {"g0": _c(min_lon), "g1": (_c(max_lon) - _c(min_lon)) / _c(width), "g2": F.lit(0.0), "g3": _c(max_lat), "g4": F.lit(0.0), "g5": -(_c(max_lat) - _c(min_lat)) / _c(height)}


def metres_per_pixel(g1=None) -> Column:
    return F.lit(222.0) if g1 is None else F.coalesce(F.abs(_c(g1)) * 111000.0, F.lit(222.0))


def bilinear(fx, fy, q00, q10, q01, q11) -> Column:
    fx, fy = _c(fx), _c(fy)
    return _c(q00) * (1 - fx) * (1 - fy) + _c(q10) * fx * (1 - fy) + _c(q01) * (1 - fx) * fy + _c(q11) * fx * fy


def mercator(lat, lon) -> tuple[Column, Column]:
    return _c(lon) * (MERCATOR_M / 180), F.log(F.tan((90 + _c(lat)) * (math.pi / 360))) * (MERCATOR_M / math.pi)


def from_mercator(x, y) -> tuple[Column, Column]:
    return F.degrees(2 * F.atan(F.exp(_c(y) * (math.pi / MERCATOR_M))) - math.pi / 2), _c(x) * (180 / MERCATOR_M)


def zoom_level(pixel_m, most: int = 20) -> Column:
    """The first zoom whose pixels are smaller than 1.1 times the input's."""
    return F.expr(f"coalesce(element_at(filter(sequence(0, {most}), z -> {2 * MERCATOR_M / 256} / pow(2, z) < 1.1 * ({_name(pixel_m)})), 1), {most})")


def _name(x) -> str:
    return x if isinstance(x, str) else str(x)


def tile_of(px, size: int = 512) -> Column:
    return F.floor(_c(px) / size)


def box_ring(lat, lon, length, heading=None) -> Column:
    """Closed ring of (lon, lat): a box of length x 0.6 length in Web Mercator; with a heading,
    the same box turned about its centre."""
    size = F.when(_c(length) > 0, _c(length)).otherwise(F.lit(50.0))
    x, y = mercator(lat, lon)
    a, b = size / 2, size * 0.3

    def corner(i, j):
        dx, dy = i * a, j * b
        if heading is not None:
            t = F.radians(90 - F.coalesce(_c(heading), F.lit(90.0)))
            dx, dy = dx * F.cos(t) - dy * F.sin(t), dx * F.sin(t) + dy * F.cos(t)
        la, lo = from_mercator(x + dx, y + dy)
        return F.struct(lo.alias("lon"), la.alias("lat"))

    return F.array(*[corner(i, j) for i, j in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))])


def extent_ring(min_lon, min_lat, max_lon, max_lat) -> Column:
    def at(lo, la):
        return F.struct(_c(lo).alias("lon"), _c(la).alias("lat"))
    return F.array(at(min_lon, min_lat), at(max_lon, min_lat), at(max_lon, max_lat), at(min_lon, max_lat), at(min_lon, min_lat))


def rotate(x, y, cx, cy, degrees) -> tuple[Column, Column]:
    t = F.radians(_c(degrees))
    dx, dy = _c(x) - _c(cx), _c(y) - _c(cy)
    return _c(cx) + dx * F.cos(t) - dy * F.sin(t), _c(cy) + dx * F.sin(t) + dy * F.cos(t)


def pixel_size_m(min_lon, min_lat, max_lon, max_lat, width, height) -> tuple[Column, Column]:
    """Mean of top and bottom, of left and right sides (sphere, within 0.6 % of an ellipsoid)."""
    top, bottom = haversine_m(max_lat, min_lon, max_lat, max_lon), haversine_m(min_lat, min_lon, min_lat, max_lon)
    left, right = haversine_m(min_lat, min_lon, max_lat, min_lon), haversine_m(min_lat, max_lon, max_lat, max_lon)
    return (top + bottom) / 2 / _c(width), (left + right) / 2 / _c(height)


def crop_bounds(row, col, height, width, size: int = 120) -> dict[str, Column]:
    half = size // 2
    r, c = F.least(F.greatest(_c(row), F.lit(half)), _c(height) - half), F.least(F.greatest(_c(col), F.lit(half)), _c(width) - half)
    return {"r0": r - half, "c0": c - half, "r1": r + half, "c1": c + half}
