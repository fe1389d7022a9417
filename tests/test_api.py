from pelagos import api
from pelagos.functions import geo
from pelagos.operators import extensions as X
from pelagos.operators import raster, windows
from pyspark.sql import functions as F

AIS = "MMSI,BaseDateTime,LAT,LON,SOG,COG,Heading,VesselType,Length,Width\n367000001,2023-06-20 23:06:42,36.5,-76.1,0.0,12,511,70,100,20\n367000002,2023-06-20 23:00:00,36.9,-76.1,0.0,12,10,70,80,15\n"
DET = "detect_id,lat,lon,confidence,vessel_length_m,vessel_width_m,vessel_speed_k,vessel_type,heading_degrees,is_fishing_vessel\n1,36.5,-76.1,0.9,100,20,0,cargo,0,0.1\n2,37.5,-75.1,0.9,50,10,0,fishing,0,0.9\n3,36.5,-76.1,0.1,50,10,0,fishing,0,0.9\n"


def test_whole_run(spark, tmp_path):
    (tmp_path / "ais.csv").write_text(AIS)
    (tmp_path / "det.csv").write_text(DET)
    r = {x.detect_id: x for x in api.analyse(spark, str(tmp_path / "det.csv"), str(tmp_path / "ais.csv"), 1687302402000000, str(tmp_path / "out")).collect()}
    assert r[1].matched_mmsi == 367000001 and r[2].is_dark_ship
    assert spark.read.text(str(tmp_path / "out/summary")).first()[0].startswith('{"total_detections":3')
    assert spark.read.text(str(tmp_path / "out/geojson")).count() == 3


def test_detections_call(spark, tmp_path):
    (tmp_path / "det.csv").write_text(DET)
    (tmp_path / "avoid.csv").write_text("lon,lat,width_m\n-75.1,37.5,\n")
    assert sorted(x.detect_id for x in api.detections(spark, str(tmp_path / "det.csv")).collect()) == [1, 2]
    assert 1 in {x.detect_id for x in api.detections(spark, str(tmp_path / "det.csv"), avoid=str(tmp_path / "avoid.csv")).collect()}


def test_extensions(spark):
    X.register_motion("still", lambda x, y, *_: (x, y))
    assert X.MOTION["still"](1, 2, 3) == (1, 2) and X.MOTION["great_circle"] is geo.destination
    t = spark.createDataFrame([(0, 0, 1, 2, b"\0\0\0\0\0\0\x80?"), (0, 1, 1, 1, b"\0\0\0\0")], "tile_row long, tile_col long, height int, width int, payload binary")
    assert [tuple(r) for r in X.apply_model(raster.not_empty(t), "bright_cells").collect()] == [(0, 0, 0, 1, 1.0)]
    assert X.process_chunks(t, [lambda d: d.filter("tile_col = 0"), lambda d: d.select("width")]).first().width == 2


def test_window_plans(spark):
    o = windows.override_parameters(0.1, None, {"window_size": 1, "overlap": 2, "nms": 0.3, "confidence": 0.3})
    assert o == {"window_size": 1, "overlap": 2, "nms": None, "confidence": 0.3}
    m = windows.metre_windows(spark, 1100, 1100, 10.0, "medium_vessels", most=1)
    assert m.filter("row_end > 1100 OR col_end > 1100").count() == 0 and windows.sliding(spark, 10, 10, 20, 5).count() == 0
    v = spark.range(16).select((F.col("id") % 4).alias("cx"), F.expr("id div 4").alias("cy"), F.lit(1.0).alias("vv"))
    assert {round(r.value, 9) for r in raster.convolve(v, "vv", "blur").collect()} == {1.0, round(6 / 9, 9), round(4 / 9, 9)}
