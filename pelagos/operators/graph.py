"""Connected components by alternating large-star and small-star, each step one aggregate and
one join; every round is written to the shared folder, so no lineage grows. At most ALONE edges
are left to a single task: rounds over so few are all planning, and the driver keeps what it has
planned."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagos.session import counted, cut, materialize, put_down, release

ALONE = 200_000


def _least(batches):
    """The components of all edges (u, v) of a task: roots are tied to the least root beside them,
    paths are cut short, until no edge joins two roots."""
    ends = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not ends:
        return
    ids, at = np.unique(np.concatenate([np.concatenate(c) for c in zip(*ends)]), return_inverse=True)
    u, v = np.split(at, 2)
    root = np.arange(len(ids))
    while len(u):
        x, y = np.maximum(root[u], root[v]), np.minimum(root[u], root[v])
        u, v, x, y = (c[x > y] for c in (u, v, x, y))
        np.minimum.at(root, x, y)
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root])], names=["id", "component"])


def _large(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of u is tied to the least of u and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b) of longs -> id, component (the least id reachable) of every id in an edge."""
    held, n = counted(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    if n <= ALONE:
        kind = held.schema["u"].dataType.simpleString()
        out = materialize(held.coalesce(1).mapInArrow(_least, f"id {kind}, component {kind}"), "components")
        release(held)
        return out
    now, before = put_down(held, n, "edges"), None
    while True:
        last, now = now, cut(_small(_large(now).filter("u <> v").distinct()).filter("u <> v").distinct(), "edges")
        release(last)
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            # every id but the least of its component has one edge now
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(now.select("v", F.col("v").alias("component")).distinct())
        before = mark
