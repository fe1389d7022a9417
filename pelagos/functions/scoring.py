"""Multi-cue scores of a detection against a report. Two sets of constants, two modes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pelagos.functions.geo import _c

#: Weights of the cues.
WEIGHTS = {
    "current": {"position": 0.25, "heading": 0.15, "size": 0.35, "speed": 0.10, "type": 0.10, "temporal": 0.05},
    "v1": {"position": 0.40, "heading": 0.20, "size": 0.20, "speed": 0.10, "type": 0.05, "temporal": 0.05},
}


def position(distance_m, params: str = "current", uncertainty=None) -> Column:
    d = _c(distance_m)
    if params == "v1":
        return F.exp(-d / (_c(uncertainty) + 100) / 2)
    return F.when(d > 500, 0.0).otherwise(F.exp(-d / 200))


def heading(detected, reported, sog, strict: bool = False) -> Column:
    """compat lets the code 511 (no heading) through, so the score may exceed 1."""
    d, r, s = _c(detected), _c(reported), _c(sog)
    x = F.abs(d - r)
    near = F.exp(-F.least(x, 360 - x) / 45)
    none = d.isNull() | r.isNull() | s.isNull() | (s < 1)
    return F.when(none | (r == 511) if strict else none, 0.5).otherwise(near)


def size(length, width, ais_length, ais_width) -> Column:
    """Null where a width is missing: such a candidate is never chosen."""
    l, w, al, aw = _c(length), _c(width), _c(ais_length), _c(ais_width)
    dl, dw = F.abs(l - al) / F.greatest(al, F.lit(1.0)), F.abs(w - aw) / F.greatest(aw, F.lit(1.0))
    return (F.when(l.isNull() | al.isNull(), 0.5).when(l < 0.5 * al, 0.0).when((dl > 0.3) | F.coalesce(dw > 0.3, F.lit(False)), 0.0)
            .otherwise(F.exp(-(dl + dw) / 2)))


def speed(detected, sog) -> Column:
    return F.coalesce(F.exp(-F.abs(_c(detected) - _c(sog)) / 10), F.lit(0.5))


def type_(detected, vtype) -> Column:
    d, t = _c(detected), _c(vtype)
    fishing = F.when(t == 30, 0.9).when(t.isin(36, 37), 0.6).when(t == 70, 0.0).otherwise(0.3)
    cargo = F.when(t.between(70, 79), 0.9).when(t == 30, 0.2).otherwise(0.5)
    return F.when(d.isNull() | t.isNull(), 0.5).when(d == "fishing", fishing).when(d == "cargo", cargo).otherwise(0.4)


def temporal(minutes) -> Column:
    return F.exp(-_c(minutes) / 30)


def total(scores: dict[str, Column], params: str = "current") -> Column:
    out = None
    for k, w in WEIGHTS[params].items():
        out = scores[k] * w if out is None else out + scores[k] * w
    return out


def bucket_heading(buckets, half: float = 0.5) -> Column:
    """Degrees from 16 bucket weights: the first of the largest, in steps of 22.5."""
    b = _c(buckets)
    return (F.array_position(b, F.array_max(b)) - 1 + half) * 22.5


def softmax(values) -> Column:
    v = _c(values)
    e = F.transform(v, lambda x: F.exp(x - F.array_max(v)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def f1(tp, fp, fn, eps: float = 0.01) -> tuple[Column, Column, Column]:
    """(f1, precision, recall); 0 where there is nothing to divide by, f1 also below eps."""
    tp, fp, fn = (_c(k).cast("double") for k in (tp, fp, fn))
    p = F.when(tp + fp == 0, 0.0).otherwise(tp / (tp + fp))
    r = F.when(tp + fn == 0, 0.0).otherwise(tp / (tp + fn))
    return F.when(p + r < eps, 0.0).otherwise(2 * p * r / (p + r)), p, r
