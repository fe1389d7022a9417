"""Maritime views over the driver's tables, in SQL that Spark and DuckDB both read.

T is the image time. Every name below is a CTE; cte(engine, name) gives it with those before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

T_US = 1705320000000000  # 2024-01-15 12:00:00
_US = {"spark": "unix_micros(cast(ts as timestamp))", "duck": "epoch_us(ts)"}

_HAV = "2e0 * 6371000e0 * atan2(sqrt({a}), sqrt(greatest(1e0 - ({a}), 0e0)))"


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = f"power(sin(radians(({lat2}) - ({lat1})) / 2e0), 2) + cos(radians({lat1})) * cos(radians({lat2})) * power(sin(radians(({lon2}) - ({lon1})) / 2e0), 2)"
    return _HAV.format(a=a)


def _clean(h: int) -> str:
    return f"""
SELECT mmsi, seq, us, lat, lon, sog, cog, heading, vtype, gap_s,
  coalesce(length, avg(length) OVER (PARTITION BY vtype), avg(length) OVER ()) AS length0, coalesce(width, avg(width) OVER (PARTITION BY vtype), avg(width) OVER ()) AS width0, length, width
FROM (SELECT mmsi, seq, us, lat, lon, sog, cog, coalesce(heading, cog) AS heading, coalesce(vtype, 90) AS vtype, length, width,
    least(greatest(cast({T_US} - us AS DOUBLE) / 1e6, 0e0), 7200e0) AS gap_s,
    row_number() OVER (PARTITION BY mmsi ORDER BY abs(us - {T_US}), seq) AS rn
  FROM ais WHERE sog IS NOT NULL AND cog IS NOT NULL AND us BETWEEN {T_US} - {h * 3600}000000 AND {T_US} + {h * 3600}000000) x WHERE rn = 1"""


#: The global mean is taken after the means of types were filled in.
_FILL = "SELECT *, coalesce(lf, avg(lf) OVER ()) AS len_f, coalesce(wf, avg(wf) OVER ()) AS wid_f FROM (SELECT *, coalesce(length, avg(length) OVER (PARTITION BY vtype)) AS lf, coalesce(width, avg(width) OVER (PARTITION BY vtype)) AS wf FROM {c}) y"

_PRED = """
SELECT mmsi, seq, us, sog, cog, heading, vtype, len_f, wid_f, gap_s,
  CASE WHEN dist < 1e0 THEN lat ELSE degrees(asin(s)) END AS plat,
  CASE WHEN dist < 1e0 THEN lon ELSE degrees(lo2 + pi() - 2e0 * pi() * floor((lo2 + pi()) / (2e0 * pi())) - pi()) END AS plon
FROM (SELECT *, radians(lon) + atan2(sin(radians(heading)) * sin(dist / 6371000e0) * cos(radians(lat)), cos(dist / 6371000e0) - sin(radians(lat)) * s) AS lo2
  FROM (SELECT *, greatest(-1e0, least(1e0, sin(radians(lat)) * cos(dist / 6371000e0) + cos(radians(lat)) * sin(dist / 6371000e0) * cos(radians(heading)))) AS s
    FROM (SELECT *, sog * 0.514444e0 * gap_s AS dist FROM {c}) a) b) c"""

VIEWS: dict[str, str] = {
    "ais": """
SELECT event_id AS seq, 200000000 + user_id AS mmsi, {us} AS us,
  36e0 + cast((event_id * 7919) % 16000 AS DOUBLE) / 1e4 AS lat, -77e0 + cast((event_id * 104729) % 20000 AS DOUBLE) / 1e4 AS lon,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE value * 30e0 / 500e0 END AS sog,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE cast((event_id * 31) % 3600 AS DOUBLE) / 1e1 END AS cog,
  CASE WHEN event_id % 7 = 0 THEN 511e0 WHEN event_id % 17 = 0 THEN NULL ELSE cast((event_id * 37) % 3600 AS DOUBLE) / 1e1 END AS heading,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE 20e0 + cast((event_id * 13) % 250 AS DOUBLE) END AS length,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE 5e0 + cast(event_id % 40 AS DOUBLE) END AS width,
  CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN 30 WHEN 2 THEN 70 WHEN 3 THEN 52 WHEN 4 THEN 36 WHEN 5 THEN 79 ELSE 60 END AS vtype
FROM {events}""",
    "clean72": _clean(72), "fill72": _FILL.format(c="clean72"), "pred72": _PRED.format(c="fill72"),
    "clean2": _clean(2), "fill2": _FILL.format(c="clean2"), "pred2": _PRED.format(c="fill2"),
    "det": """
SELECT cast(mmsi - 200000000 AS BIGINT) AS detect_id, cast((mmsi - 200000000) % 4 AS BIGINT) AS scene_id,
  round(plat, 6) + cast((mmsi % 7) - 3 AS DOUBLE) * 0.0005e0 AS lat, round(plon, 6) + cast((mmsi % 5) - 2 AS DOUBLE) * 0.0005e0 AS lon,
  0.3e0 + cast((mmsi * 17) % 70 AS DOUBLE) / 100e0 AS confidence,
  CASE WHEN mmsi % 8 = 0 THEN NULL ELSE round(len_f, 2) * (0.7e0 + cast(mmsi % 7 AS DOUBLE) / 10e0) END AS vessel_length_m,
  CASE WHEN mmsi % 9 = 0 THEN NULL ELSE round(wid_f, 2) * (0.8e0 + cast(mmsi % 5 AS DOUBLE) / 10e0) END AS vessel_width_m,
  CASE WHEN mmsi % 10 = 0 THEN NULL ELSE sog + cast(mmsi % 6 AS DOUBLE) END AS vessel_speed_k,
  CASE WHEN mmsi % 3 = 0 THEN 'fishing' WHEN mmsi % 3 = 1 THEN 'cargo' ELSE NULL END AS vessel_type,
  CASE WHEN mmsi % 12 = 0 THEN NULL ELSE cast((mmsi * 45) % 16 AS DOUBLE) * 22.5e0 END AS heading_degrees,
  CASE WHEN mmsi % 3 = 0 THEN 0.8e0 ELSE 0.2e0 END AS is_fishing_vessel
FROM pred72
UNION ALL
SELECT cast(1000000 + seq AS BIGINT), cast(seq % 4 AS BIGINT), lat + 5e0, lon, 0.2e0 + cast((seq * 29) % 80 AS DOUBLE) / 100e0,
  CASE WHEN seq % 4 = 0 THEN NULL ELSE cast((seq * 3) % 600 AS DOUBLE) END, CASE WHEN seq % 5 = 0 THEN NULL ELSE cast(seq % 60 AS DOUBLE) END,
  CASE WHEN seq % 6 = 0 THEN NULL ELSE cast((seq * 7) % 64 AS DOUBLE) END, CASE WHEN seq % 2 = 0 THEN 'cargo' WHEN seq % 5 = 0 THEN 'other' ELSE NULL END,
  cast((seq * 11) % 16 AS DOUBLE) * 22.5e0, cast(seq % 10 AS DOUBLE) / 10e0
FROM ais WHERE seq % 53 = 0""",
    "detbox": """
SELECT *, (detect_id * 37) % 1500 AS preprocess_row, (detect_id * 91) % 1500 AS preprocess_column,
  (detect_id * 91) % 1500 - 20 - detect_id % 9 AS bbox_x1, (detect_id * 37) % 1500 - 15 - detect_id % 7 AS bbox_y1,
  (detect_id * 91) % 1500 + 20 + detect_id % 11 AS bbox_x2, (detect_id * 37) % 1500 + 15 + detect_id % 5 AS bbox_y2 FROM det""",
    "images": "SELECT p_partkey AS id, p_name AS name, p_brand AS uuid, p_size AS width, p_size * 2 AS height FROM {part}",
    "windows": "SELECT o_orderkey AS id, cast(o_custkey % 50 AS BIGINT) AS dataset_id, cast(o_orderkey % 2000 + 1 AS BIGINT) AS image_id, CASE o_orderkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split, o_orderkey % 1000 AS row_px, o_custkey % 1000 AS col_px FROM {orders}",
    "labels": "SELECT l_orderkey AS window_id, l_partkey AS row_px, l_suppkey AS col_px, l_quantity AS length, l_discount AS speed, l_returnflag AS value FROM {lineitem}",
    "avoid": "SELECT * FROM (VALUES (-76.5e0, 36.5e0, 20000e0), (-75.9e0, 37.2e0, 9000e0), (-76.1e0, 2e0, 5000e0), (-76.9e0, 36.1e0, CAST(NULL AS DOUBLE))) AS t(alon, alat, width_m)",
    "coast": "SELECT * FROM (VALUES " + ", ".join(f"({i}, {36.0 + 0.1 * i:.1f}e0, {-76.0 - 0.05 * (i % 5):.2f}e0)" for i in range(17)) + ") AS t(cid, clat, clon)",
    "strategy": "SELECT * FROM (VALUES ('small', 1), ('medium', 2), ('large', 3)) AS t(category, priority)",
    # Every event, on as many rows of 64 cells as they fill.
    "cells": "SELECT event_id % 64 AS cx, cast(floor(event_id / 64e0) AS BIGINT) AS cy, max(CASE WHEN (event_id * 7919) % 100 < 62 THEN 1 ELSE 0 END) AS water, max(cast((event_id * 31) % 251 AS DOUBLE)) AS vv, max(cast((event_id * 17) % 241 AS DOUBLE)) AS vh FROM {events} GROUP BY 1, 2",
    "truth": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY abs(us - {T_US}), seq) AS rn FROM ais WHERE us BETWEEN {T_US} - 259200000000 AND {T_US} + 259200000000 AND lat BETWEEN 36.2e0 AND 37.4e0 AND lon BETWEEN -76.8e0 AND -75.3e0) g WHERE rn = 1",
    # Every event, in scenes of 250 boxes; a prediction lies near the truth of the next event.
    "boxes": "SELECT event_id AS id, cast(floor(event_id / 250e0) AS BIGINT) AS scene_id, event_id % 2 AS is_gt, cast(((event_id + 1 - event_id % 2) * 37) % 400 + (1 - event_id % 2) * (event_id % 23 - 11) AS DOUBLE) AS x, cast(((event_id + 1 - event_id % 2) * 91) % 400 + (1 - event_id % 2) * (event_id % 19 - 9) AS DOUBLE) AS y, cast((event_id * 13) % 100 AS DOUBLE) / 100e0 AS score FROM {events}",
}


def cte(engine: str, *names: str, tables: dict | None = None) -> str:
    """WITH clause holding the views named and all they need. tables: {name: SQL relation}."""
    need: list[str] = []

    def add(n: str):
        if n in need:
            return
        for other in VIEWS:
            if other != n and _uses(VIEWS[n], other):
                add(other)
        need.append(n)

    for n in names:
        add(n)
    tables = tables or {}
    out = []
    for n in need:
        sql = VIEWS[n].replace("{us}", _US[engine])
        for t in ("events", "part", "orders", "lineitem"):
            sql = sql.replace("{" + t + "}", tables.get(t, t))
        if engine == "spark":
            sql = sql.replace("pi()", "pi()")
        out.append(f"{n} AS ({sql})")
    return "WITH " + ",\n".join(out) + "\n"


def _uses(sql: str, name: str) -> bool:
    import re
    return re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql) is not None


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in ("events", "part", "orders", "lineitem")}
    return spark.sql(cte("spark", name, tables=tables) + f"SELECT * FROM {name}")
