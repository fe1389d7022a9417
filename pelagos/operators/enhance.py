"""Enhancement and augmentation of tiles, as numpy functions over uint8 or float arrays (bands,
height, width), and over tables of tiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def clahe(band: np.ndarray, clip: float = 2.0, grid: int = 8) -> np.ndarray:
    """Contrast-limited adaptive equalisation of uint8: histograms of grid x grid squares, cut at
    `clip` times their mean with the excess spread evenly, blended bilinearly."""
    h, w = band.shape
    th, tw = -(-h // grid), -(-w // grid)
    padded = np.pad(band, ((0, th * grid - h), (0, tw * grid - w)), mode="reflect" if min(h, w) > max(th, tw) else "edge")
    area = th * tw
    limit = max(1, int(clip * area / 256))
    maps = np.empty((grid, grid, 256))
    for i in range(grid):
        for j in range(grid):
            n = np.bincount(padded[i * th:(i + 1) * th, j * tw:(j + 1) * tw].reshape(-1), minlength=256)
            over = int(np.maximum(n - limit, 0).sum())
            n = np.minimum(n, limit) + over // 256
            rest = over % 256
            if rest:
                n[::max(256 // rest, 1)][:rest] += 1
            maps[i, j] = np.clip(np.rint(np.cumsum(n) * (255 / area)), 0, 255)

    def near(size: int, step: int):
        at = np.arange(size) / step - 0.5
        lo = np.floor(at).astype(int)
        return np.clip(lo, 0, grid - 1), np.clip(lo + 1, 0, grid - 1), at - lo
    y0, y1, fy = near(h, th)
    x0, x1, fx = near(w, tw)
    fy, fx = fy[:, None], fx[None]
    get = lambda y, x: maps[y[:, None], x[None], band]
    out = (get(y0, x0) * (1 - fx) + get(y0, x1) * fx) * (1 - fy) + (get(y1, x0) * (1 - fx) + get(y1, x1) * fx) * fy
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def blurred(band: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian, separable, mirrored at the edges."""
    r = max(1, int(round(sigma * 3)))
    k = np.exp(-np.arange(-r, r + 1) ** 2 / (2 * sigma ** 2))
    k /= k.sum()
    out = band.astype(np.float64)
    for axis in (0, 1):
        p = np.pad(out, [(r, r) if a == axis else (0, 0) for a in (0, 1)], mode="reflect" if out.shape[axis] > r else "edge")
        out = sum(w * np.take(p, np.arange(i, i + out.shape[axis]), axis) for i, w in enumerate(k))
    return out


def unsharp(band: np.ndarray, sigma: float = 2.0, amount: float = 0.5) -> np.ndarray:
    return np.clip(np.rint(band * (1 + amount) - amount * np.rint(blurred(band, sigma))), 0, 255).astype(np.uint8)


def bilateral(band: np.ndarray, size: int = 9, colour: float = 75.0, space: float = 75.0) -> np.ndarray:
    """Means over a disc, weighted by nearness in place and in value."""
    r, a = size // 2, band.astype(np.float64)
    p = np.pad(a, r, mode="reflect" if min(a.shape) > r else "edge")
    total, weight = np.zeros_like(a), np.zeros_like(a)
    for i in range(-r, r + 1):
        for j in range(-r, r + 1):
            if i * i + j * j <= r * r:
                x = p[r + i:r + i + a.shape[0], r + j:r + j + a.shape[1]]
                w = np.exp(-(i * i + j * j) / (2 * space ** 2) - (x - a) ** 2 / (2 * colour ** 2))
                total += w * x
                weight += w
    return np.rint(total / weight).astype(np.uint8)


def enhance(tile: np.ndarray, catalog: str = "sentinel1") -> np.ndarray:
    """Radar: every band equalised. Optical: the first three sharpened. Others stay."""
    tile = tile.astype(np.uint8) if catalog in ("sentinel1", "sentinel2") else tile
    if catalog == "sentinel1":
        return np.stack([clahe(b) for b in tile])
    return np.stack([unsharp(b) if i < 3 else b for i, b in enumerate(tile)]) if catalog == "sentinel2" else tile


def speckle(tile: np.ndarray, catalog: str = "sentinel1") -> np.ndarray:
    return np.stack([bilateral(b.astype(np.uint8)) for b in tile]) if catalog == "sentinel1" else tile


# ---- augmentations of (bands, height, width) in 0..1; rng makes them repeatable


def noise(tile: np.ndarray, rng: np.random.Generator, channels=()) -> np.ndarray:
    return np.clip(tile + 0.1 * rng.standard_normal(tile.shape), 0, 1)


def jitter(tile: np.ndarray, rng: np.random.Generator, channels=(), strength: float = 0.4) -> np.ndarray:
    return np.clip(tile + strength * (rng.random(len(tile)) - 0.5)[:, None, None], 0, 1)


def small_jitter(tile: np.ndarray, rng: np.random.Generator, channels=()) -> np.ndarray:
    return jitter(tile, rng, channels, 0.1)


def bucket(tile: np.ndarray, rng: np.random.Generator, channels=()) -> np.ndarray:
    """The first two bands in ten steps whose edges are shifted at random."""
    out = tile.astype(np.float64)
    for i in range(min(2, len(out))):
        edges = (np.arange(1, 10) + rng.random(9) - 0.5) / 10
        out[i] = np.searchsorted(edges, out[i], side="left") / 10
    return out


def hide_overlapping(tile: np.ndarray, rng: np.random.Generator, channels=()) -> np.ndarray:
    """In one case of five the bands of other passes become black, or 255."""
    if rng.random() >= 0.2:
        return tile
    out, value = tile.copy(), 0 if rng.random() < 0.5 else 255
    out[[i for i, c in enumerate(channels) if "overlap" in c]] = value
    return out


AUGMENTATIONS: dict[str, Callable] = {"Noise": noise, "Jitter": jitter, "Jitter2": small_jitter, "Bucket": bucket, "HideOverlapping": hide_overlapping}


def over_tiles(tiles: DataFrame, steps: list[str], channels: tuple[str, ...], seed: int = 0) -> DataFrame:
    """tiles(id, bands, height, width, payload float32) with augmentations applied in turn; the same
    for the same id and seed."""
    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for t in f.itertuples(index=False):
                a, rng = np.frombuffer(t.payload, "<f4").reshape(t.bands, t.height, t.width), np.random.default_rng([seed, t.id])
                for s in steps:
                    a = AUGMENTATIONS[s](a, rng, channels)
                out.append(a.astype("<f4").tobytes())
            yield f.assign(payload=out)
    return tiles.select("id", "bands", "height", "width", "payload").mapInPandas(task, "id long, bands int, height int, width int, payload binary")
