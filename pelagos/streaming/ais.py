"""Reports as a stream: late and repeated reports dropped, the last position per vessel, and
detections of a scene matched to them. An extension; batch operators are reused as they are."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deduplicated(stream: DataFrame, late: str = "6 hours") -> DataFrame:
    """stream(mmsi, ts, lat, lon, ...) without repeated reports inside the watermark."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(["mmsi", "lat", "lon"])


def counts_per_window(stream: DataFrame, late: str = "6 hours", width: str = "1 hour") -> DataFrame:
    return stream.withWatermark("ts", late).groupBy(F.window("ts", width), "mmsi").agg(F.count(F.lit(1)).alias("reports"), F.max("sog").alias("fastest"))


def last_position(stream: DataFrame) -> DataFrame:
    """The newest report of each vessel, kept as state; a late one doesn't replace a newer."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def newest(key, frames, state: GroupState):
        at, lat, lon = state.get if state.exists else (-1, 0.0, 0.0)
        for f in frames:
            f = f.assign(us=f["ts"].astype("datetime64[us]").astype("int64"))
            r = f.loc[f["us"].idxmax()]
            if r["us"] > at:
                at, lat, lon = int(r["us"]), float(r["lat"]), float(r["lon"])
        state.update((at, lat, lon))
        yield pd.DataFrame({"mmsi": [key[0]], "us": [at], "lat": [lat], "lon": [lon]})

    return stream.select("mmsi", "ts", "lat", "lon").groupBy("mmsi").applyInPandasWithState(newest, "mmsi long, us long, lat double, lon double", "us long, lat double, lon double", "update", GroupStateTimeout.NoTimeout)


def match_batches(stream: DataFrame, detections: DataFrame, t_us: int, sink) -> object:
    """Starts a query that correlates each micro-batch with the detections and hands (results,
    batch id) to the sink."""
    from pelagos.operators.correlate import correlate

    def one(batch: DataFrame, number: int) -> None:
        sink(correlate(detections, batch, t_us, fallback_hours=None), number)

    return stream.writeStream.foreachBatch(one)
