"""Window plans (V), masks and rasters (F15, F17, J16, J17, R), metadata lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagos.operators import raster, windows as V
from pelagos.plans.adapters import cte, view
from pelagos.plans.catalog import query

C, B = cte("duck", "cells"), cte("duck", "detbox")


#: Rows of the image of all cells, 64 at least.
HEIGHT = "(SELECT greatest(max(cy) + 1, 64) FROM cells)"


def tall(spark, d):
    return max(64, view(spark, d, "cells").agg(F.coalesce(F.max("cy") + 1, F.lit(0))).first()[0])


def _grid(h, w, size, step):
    return f"SELECT r.v AS row, c.v AS col FROM (SELECT unnest(range(0, {h} - {size} + 1, {step})) AS v) r, (SELECT unnest(range(0, {w - size + 1}, {step})) AS v) c"


query("v01_sliding", _grid(3000, 4000, 800, 750))(lambda spark, d: V.sliding(spark, 3000, 4000, 800, 750))
query("v02_sliding_with_edge", _grid(3000, 4000, 800, 750) + " UNION ALL SELECT 2200, 0 UNION ALL SELECT 0, 3200")(lambda spark, d: V.sliding_with_edge(spark, 3000, 4000, 800, 50))
query("v05_padded", "SELECT row + 100 AS row, col + 100 AS col FROM (" + _grid(2800, 3800, 512, 400) + ") x")(lambda spark, d: V.padded(spark, 3000, 4000, 512, 400, 100))


@query("v03_clamped_offsets", "SELECT r AS row, c AS col FROM (SELECT DISTINCT r FROM (SELECT least(i * 820, 3000 - 1024) AS r FROM range(0, (3000 - 1024) // 820 + 1) t(i) UNION ALL SELECT 1976) a) x, (SELECT DISTINCT c FROM (SELECT least(i * 820, 4000 - 1024) AS c FROM range(0, (4000 - 1024) // 820 + 1) t(i) UNION ALL SELECT 2976) b) y")
def clamped(spark, d):
    return V.clamped(spark, 3000, 4000, 1024, 0.2)


@query("v04_t07_metre_windows", "WITH m AS (SELECT row, col, row + 1024 AS row_end, col + 1024 AS col_end FROM (" + _grid(2597, 1673, 1024, 871) + """) x),
e AS (SELECT DISTINCT * FROM (SELECT unnest(range(0, 1574, 512)) AS row, 649 AS col UNION ALL SELECT 1573, unnest(range(0, 650, 512))) y)
SELECT * FROM m UNION ALL SELECT row, col, 2597, 1673 FROM e WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.row = e.row AND m.col = e.col)""")
def metres(spark, d):
    return V.metre_windows(spark, 2597, 1673, 10.0, "medium_vessels")


@query("v10_chunks", "SELECT r AS row, c AS col, greatest(r + 600 - 2000, 0) AS pad_rows, greatest(c + 700 - 2500, 0) AS pad_cols FROM (SELECT unnest(range(0, 2000, 550)) AS r) a, (SELECT unnest(range(0, 2500, 650)) AS c) b")
def chunks(spark, d):
    return V.chunks(spark, 2000, 2500, 600, 700, 50)


@query("v07_megapixel_strategy", cte("duck", "images") + "SELECT id, CASE WHEN width * height * 100000 > 400000000 THEN 'ocean_deep' WHEN width * height * 100000 > 200000000 THEN 'ocean_coastal' WHEN width * height * 100000 > 100000000 THEN 'harbor_detail' ELSE 'ultra_detail' END AS strategy FROM images")
def strategy(spark, d):
    return view(spark, d, "images").select("id", V.megapixel_strategy(F.col("width").cast("long") * F.col("height") * 100000).alias("strategy"))


@query("v08_vessel_windows", "SELECT category, CAST(s AS INTEGER) AS window_size, round(greatest(least(px * 0.5e0 / s, 0.7e0), 0.1e0), 6) AS overlap_ratio, round(px * 1.2e0, 6) AS nms_px FROM (SELECT category, px, greatest(least(power(2e0, ceil(log2(px * 2))), 1024e0), 256e0) AS s FROM (SELECT category, max_m / resolution AS px FROM (VALUES ('small_vessels', 50e0, 10e0), ('medium_vessels', 150e0, 1e0), ('large_vessels', 400e0, 0.5e0)) t(category, max_m, resolution)) a) b")
def vessel(spark, d):
    c = spark.sql("SELECT * FROM VALUES ('small_vessels', 50e0, 10e0), ('medium_vessels', 150e0, 1e0), ('large_vessels', 400e0, 0.5e0) AS t(category, max_m, resolution)")
    return V.vessel_windows(c).select("category", "window_size", F.round("overlap_ratio", 6).alias("overlap_ratio"), F.round("nms_px", 6).alias("nms_px"))


_REG = "SELECT * FROM (VALUES (1, 'large', 4000000, 0.9e0, 150e0, 500, 600, 3000, 2500), (2, 'medium', 900000, 0.6e0, 40e0, 4000, 200, 900, 1000), (3, 'small', 70000, 0.3e0, 5e0, 100, 5000, 200, 300)) AS t(region, kind, area, density, edge, x, y, w, h)"


@query("v06_v09_region_windows", f"""WITH a AS ({_REG}), b AS (SELECT *, CASE kind WHEN 'large' THEN 2048 WHEN 'medium' THEN 1024 ELSE 512 END * ((1 + (density - 0.5e0) * 0.4e0) * (1 + least(edge / 200e0, 0.3e0)) * (1 + least((area - 1000000) / 1e7, 0.2e0))) AS want,
 least(CASE kind WHEN 'large' THEN 0.05e0 WHEN 'medium' THEN 0.15e0 ELSE 0.25e0 END + ((1 - density) + (1 - least(edge / 100e0, 1e0))) * 0.1e0, 0.4e0) AS ratio FROM a), c AS (SELECT *, greatest(256, least(CAST(trunc(want) AS INTEGER), 4096)) AS size FROM b),
 e AS (SELECT *, CAST(trunc(size * ratio) AS INTEGER) AS ov FROM c), r AS (SELECT *, unnest(range(greatest(0, y - ov), least(8000 - size, y + h + ov) + 1, size - ov)) AS row FROM e),
 k AS (SELECT *, unnest(range(greatest(0, x - ov), least(7000 - size, x + w + ov) + 1, size - ov)) AS col FROM r)
SELECT region, row, col, size, round(least(area / 9e6, 1e0) * 0.4e0 + density * 0.4e0 + least(edge / 100e0, 1e0) * 0.2e0, 6) AS priority FROM k""")
def regions(spark, d):
    r = spark.sql(_REG)
    w = V.region_windows(r, 8000, 7000)
    return w.join(r.select("region", F.round(V.region_priority(), 6).alias("priority")), "region").select("region", "row", "col", "size", "priority")


@query("v09_region_priority", f"SELECT region, round(least(area / 9e6, 1e0) * 0.4e0 + density * 0.4e0 + least(edge / 100e0, 1e0) * 0.2e0, 6) AS priority FROM ({_REG}) r")
def priority(spark, d):
    return spark.sql(_REG).select("region", F.round(V.region_priority(), 6).alias("priority"))


@query("v11_chip_choice", cte("duck", "windows") + "SELECT id, (row_px * 2 - 128) // 2 AS chip_row, (col_px * 2 - 128) // 2 AS chip_col FROM windows WHERE split = 'val' AND row_px > 64 AND col_px > 64")
def chip(spark, d):
    return view(spark, d, "windows").filter("split = 'val' AND row_px > 64 AND col_px > 64").select("id", F.expr("(row_px * 2 - 128) div 2").alias("chip_row"), F.expr("(col_px * 2 - 128) div 2").alias("chip_col"))


@query("v12_parameter_override", "SELECT u, CASE WHEN u < 0.3e0 - 0.05e0 THEN 0.3e0 ELSE u END AS confidence FROM (VALUES (0.1e0), (0.26e0), (0.5e0)) t(u)")
def override(spark, d):
    u = F.col("u")
    return spark.sql("SELECT * FROM VALUES (0.1e0), (0.26e0), (0.5e0) AS t(u)").select("u", F.when(u < 0.3 - 0.05, 0.3).otherwise(u).alias("confidence"))


@query("v13_channel_layout", cte("duck", "images") + "SELECT id, CASE WHEN id % 2 = 0 AND id % 9 >= 6 THEN 6 WHEN id % 2 = 0 AND id % 9 >= 2 THEN 2 WHEN id % 2 = 0 THEN 1 ELSE id % 9 END AS channels FROM images WHERE id % 9 > 0")
def layout(spark, d):
    i = view(spark, d, "images").filter("id % 9 > 0")
    return i.select("id", F.size(V.channel_layout((F.col("id") % 9).cast("int"), F.when(F.col("id") % 2 == 0, "sentinel1").otherwise("sentinel2"))).cast("long").alias("channels"))


@query("f17_window_coverage", C + ", w AS (" + _grid(HEIGHT, 64, 16, 12) + ") SELECT w.row, w.col, round(sum(CASE WHEN water = 1 THEN 1 ELSE 0 END) / 256e0, 6) AS water_share FROM w LEFT JOIN cells ON cy >= row AND cy < row + 16 AND cx >= col AND cx < col + 16 GROUP BY w.row, w.col HAVING sum(CASE WHEN water = 1 THEN 1 ELSE 0 END) / 256e0 >= 0.6e0")
def cover(spark, d):
    w = raster.coverage(V.sliding(spark, tall(spark, d), 64, 16, 12), view(spark, d, "cells"), 16)
    return w.filter("water_share >= 0.6").select("row", "col", F.round("water_share", 6).alias("water_share"))


@query("f15_j17_land_proximity", C + ", p AS (SELECT detect_id AS id, preprocess_column % 64 AS px, preprocess_row % " + HEIGHT + " AS py FROM (" + B + "SELECT * FROM detbox) b) SELECT id FROM p JOIN cells ON cx >= px - 5 AND cx < px + 5 AND cy >= py - 5 AND cy < py + 5 GROUP BY id HAVING avg(water) >= 0.6e0 AND max(CASE WHEN cx = px AND cy = py THEN water END) = 1")
def land(spark, d):
    p = view(spark, d, "detbox").select(F.col("detect_id").alias("id"), (F.col("preprocess_column") % 64).alias("cx"), (F.col("preprocess_row") % tall(spark, d)).alias("cy"))
    return raster.near_land(p, view(spark, d, "cells"), 5, 0.6)


@query("r01_water_mask", C + ", s AS (SELECT avg(CASE WHEN vv = 0 THEN 1e0 ELSE 0e0 END) AS z, quantile_cont(CASE WHEN vv > 0 THEN vv END, 0.25) AS qv, quantile_cont(CASE WHEN vh > 0 THEN vh END, 0.25) AS qh FROM cells) SELECT cx, cy, CASE WHEN z > 0.3e0 THEN vv = 0 ELSE vv < qv AND vh < qh END AS is_water FROM cells, s")
def mask(spark, d):
    return raster.water_mask(view(spark, d, "cells")).select("cx", "cy", "is_water")


@query("r03_r04_r14_channels", C + "SELECT cx, cy, CASE WHEN water = 1 THEN vv ELSE 0e0 END AS vv, CAST(floor(least(greatest(vv / 200e0, 0e0), 1e0) * 255) AS BIGINT) AS byte_vv, round(sqrt(vv * vh + 1e-6), 6) AS mean_amp, round(least(vv / (vh + 1e-6) * 50, 255e0), 6) AS ratio FROM cells")
def channels(spark, d):
    c = view(spark, d, "cells")
    k = raster.derived_channels(c).select("cx", "cy", raster.to_byte("vv", 0.0, 200.0).alias("byte_vv"), F.round("mean_amp", 6).alias("mean_amp"), F.round("ratio", 6).alias("ratio"))
    return raster.masked(c).select("cx", "cy", "vv").join(k, ["cx", "cy"])


@query("r06_alignment_offset", C + ", s AS (SELECT * FROM (VALUES (-2, -2), (-2, 1), (1, -2), (1, 1)) AS t(dy, dx)) SELECT dy, dx, avg(a.vv * b.vv) AS mean FROM s, cells a, cells b WHERE a.cx = b.cx + 2 + dx AND a.cy = b.cy - 1 + dy GROUP BY dy, dx ORDER BY mean DESC, dy, dx LIMIT 1")
def alignment(spark, d):
    c = view(spark, d, "cells")
    return raster.best_offset(c.select("cx", "cy", F.col("vv").alias("v")), c.select((F.col("cx") + 2).alias("cx"), (F.col("cy") - 1).alias("cy"), F.col("vv").alias("v")))


@query("j16_window_tiles", cte("duck", "windows") + ", t AS (SELECT r AS tile_row, c AS tile_col, r * 10 + c AS payload FROM range(0, 2) a(r), range(0, 2) b(c)), w AS (SELECT id, unnest(range(CAST(floor(col_px / 512e0) AS BIGINT), CAST(floor((col_px + 127) / 512e0) AS BIGINT) + 1)) AS tile_col, row_px FROM windows WHERE dataset_id = 5), x AS (SELECT id, tile_col, unnest(range(CAST(floor(row_px / 512e0) AS BIGINT), CAST(floor((row_px + 127) / 512e0) AS BIGINT) + 1)) AS tile_row FROM w) SELECT x.id, x.tile_col, x.tile_row, t.payload FROM x LEFT JOIN t USING (tile_row, tile_col)")
def tiles(spark, d):
    t = spark.range(4).select(F.expr("id div 2").alias("tile_row"), (F.col("id") % 2).alias("tile_col"), (F.expr("id div 2") * 10 + F.col("id") % 2).alias("payload"))
    return raster.stitch(view(spark, d, "windows").filter("dataset_id = 5"), t, 128, 128).select("id", "tile_col", "tile_row", "payload")


@query("s07_s09_metadata_lookups", cte("duck", "windows", "images", "labels") + "SELECT w.id, w.split, i.uuid, count(l.window_id) AS labels FROM windows w JOIN images i ON i.id = w.image_id LEFT JOIN labels l ON l.window_id = w.id WHERE w.dataset_id = 11 AND w.split = 'test' GROUP BY w.id, w.split, i.uuid")
def lookups(spark, d):
    from pelagos.sources import metadata as M
    w = M.windows_of(view(spark, d, "windows"), 11, ["test"])
    i = view(spark, d, "images").select(F.col("id").alias("image_id"), "uuid")
    n = view(spark, d, "labels").groupBy(F.col("window_id").alias("id")).agg(F.count(F.lit(1)).alias("labels"))
    return w.join(i, "image_id").join(n, "id", "left").select("id", "split", "uuid", F.coalesce("labels", F.lit(0)).alias("labels"))


_AT = lambda dx, dy: f"coalesce((SELECT n.vv FROM cells n WHERE n.cx = c.cx + {dx} AND n.cy = c.cy + {dy}), 0e0)"


@query("r04_sobel_kernel", C + f"SELECT cx, cy, round(-1 * {_AT(-1, -1)} + {_AT(1, -1)} - 2 * {_AT(-1, 0)} + 2 * {_AT(1, 0)} - {_AT(-1, 1)} + {_AT(1, 1)}, 6) + 0e0 AS value FROM cells c")
def sobel(spark, d):
    return raster.convolve(view(spark, d, "cells"), "vv", "sobel_x").select("cx", "cy", (F.round("value", 6) + 0.0).alias("value"))


@query("a34_window_statistics", C + ", w AS (" + _grid(HEIGHT, 64, 8, 8) + "), s AS (SELECT w.row, w.col, sum(CASE WHEN vv > 240 THEN 1 ELSE 0 END) AS n FROM w LEFT JOIN cells ON cy >= row AND cy < row + 8 AND cx >= col AND cx < col + 8 GROUP BY w.row, w.col) SELECT count(*) AS total, count(CASE WHEN n = 0 THEN 1 END) AS skipped, round(100e0 * count(CASE WHEN n = 0 THEN 1 END) / count(*), 6) AS skipped_pct FROM s")
def window_stats(spark, d):
    cells = view(spark, d, "cells").withColumn("water", F.when(F.col("vv") > 240, 1).otherwise(0))
    w = raster.coverage(V.sliding(spark, tall(spark, d), 64, 8, 8), cells, 8)
    none = F.count_if(F.col("water_share") == 0)
    return w.agg(F.count(F.lit(1)).alias("total"), none.alias("skipped"), F.round(100.0 * none / F.count(F.lit(1)), 6).alias("skipped_pct"))


@query("x07_model_as_table_function", C + ", t AS (SELECT *, cy // 8 AS tile_row, cx // 8 AS tile_col, row_number() OVER (PARTITION BY cy // 8, cx // 8 ORDER BY cy, cx) - 1 AS place FROM cells) SELECT tile_row, tile_col, 0 AS row, CAST(min(place) AS INTEGER) AS col, CAST(1 AS DOUBLE) AS score FROM t WHERE water = 1 GROUP BY tile_row, tile_col")
def model(spark, d):
    """Tiles of 8 x 8 cells, one row of float32 each: 1 is water."""
    from pelagos.operators import extensions as X
    t = view(spark, d, "cells").groupBy(F.expr("cy div 8").alias("tile_row"), F.expr("cx div 8").alias("tile_col")).agg(F.array_sort(F.collect_list(F.struct("cy", "cx", "water"))).alias("c"))
    t = t.select("tile_row", "tile_col", F.lit(1).alias("height"), F.size("c").alias("width"), F.expr("unhex(array_join(transform(c, x -> if(x.water = 1, '0000803F', '00000000')), ''))").alias("payload"))
    return X.apply_model(raster.not_empty(t), "bright_cells")
