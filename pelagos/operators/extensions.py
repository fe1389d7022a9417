"""Extension points: motion models, evaluators, chunk processors and detection models by name."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame

from pelagos.functions import geo
from pelagos.operators import analytics

MOTION: dict[str, Callable[..., tuple]] = {"constant_velocity": geo.constant_velocity, "constant_turn": geo.constant_turn, "great_circle": geo.destination}
EVALUATORS: dict[str, Callable[[DataFrame], DataFrame]] = {"errors": analytics.error_metrics, "average_precision": lambda df: analytics.average_precision(df, 0.5, 24.0)}
MODELS: dict[str, tuple[Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], str]] = {}


def register_motion(name: str, fn: Callable[..., tuple[Column, ...]]) -> None:
    """fn takes columns and gives columns, so a model of one's own stays inside the plan."""
    MOTION[name] = fn


def register_evaluator(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    EVALUATORS[name] = fn


def register_model(name: str, schema: str):
    """Decorator: fn(frames) -> frames over tiles, with the schema of its rows (0..n for a tile)."""
    def add(fn):
        MODELS[name] = (fn, schema)
        return fn
    return add


def apply_model(tiles: DataFrame, name: str) -> DataFrame:
    """A model's rows for a table of tiles, batch by batch."""
    fn, schema = MODELS[name]
    return tiles.mapInPandas(fn, schema)


def process_chunks(df: DataFrame, processors: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Transforms chosen by configuration, one after the other."""
    for p in processors:
        df = p(df)
    return df


@register_model("bright_cells", "tile_row long, tile_col long, row int, col int, score double")
def bright_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The brightest cell of each float32 tile that isn't all zero: a stand-in for a detector."""
    import numpy as np

    for f in frames:
        rows = []
        for t in f.itertuples(index=False):
            a = np.frombuffer(t.payload, "<f4").reshape(t.height, t.width)
            if a.any():
                r, c = divmod(int(a.argmax()), t.width)
                rows.append((t.tile_row, t.tile_col, r, c, float(a.max())))
        yield pd.DataFrame(rows, columns=["tile_row", "tile_col", "row", "col", "score"])
