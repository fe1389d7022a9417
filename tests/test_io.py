import struct

import numpy as np
from pyspark.sql import functions as F

from pelagos.sources import metadata, readers, sinks


def test_ais_csv(spark, tmp_path):
    (tmp_path / "ais.csv").write_text("MMSI,BaseDateTime,LAT,LON,SOG,COG,Heading,VesselName,VesselType,Length\n367000001,2023-06-20 23:06:00,36.5,-76.1,3.4,12,511,A B,70.0,\n,2023-06-20 23:06:00,36.5,-76.1,,,,,,\n")
    rows = readers.read_ais(spark, str(tmp_path / "ais.csv")).collect()
    assert len(rows) == 2 and rows[0].MMSI == 367000001 and rows[0].VesselType == 70.0 and rows[0].Length is None and str(rows[0].BaseDateTime) == "2023-06-20 23:06:00"
    only = readers.read_ais(spark, str(tmp_path / "ais.csv"), True)
    assert only.count() == 1 and readers.ais_columns(only).first().heading == 511


def test_old_and_new_detections(spark, tmp_path):
    (tmp_path / "a.csv").write_text("preprocess_row,preprocess_column,lon,lat,score,vessel_length_m,is_fishing_vessel,detect_id\n1,2,-76,36,0.9,50,0.7,3\n")
    r = readers.read_detections(spark, str(tmp_path / "a.csv"), True).first()
    assert (r.detect_id, r.confidence, r.is_fishing_vessel, r.vessel_type) == (3, 0.9, 0.7, None)


def test_correlation_sentinel(spark, tmp_path):
    df = spark.createDataFrame([(1, 367000001, 0.8), (2, None, 0.0)], "detect_id long, matched_mmsi long, match_confidence double")
    sinks.write_csv(sinks.correlation_csv(df), str(tmp_path / "c"))
    assert "UNKNOWN" in "".join(p.read_text() for p in (tmp_path / "c").glob("*.csv"))
    assert sorted((r.detect_id, r.matched_mmsi) for r in readers.read_correlation(spark, str(tmp_path / "c")).collect()) == [(1, 367000001), (2, None)]


def test_product_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<product><geolocationGrid><geolocationGridPointList><geolocationGridPoint><line>0</line><pixel>10</pixel><latitude>36.1</latitude><longitude>-76.2</longitude></geolocationGridPoint><geolocationGridPoint><line>5</line><pixel>20</pixel><latitude>36.2</latitude><longitude>-76.3</longitude></geolocationGridPoint></geolocationGridPointList></geolocationGrid></product>")
    assert [(r.cx, r.lat) for r in readers.read_geolocation_grid(spark, str(tmp_path / "a.xml")).orderBy("cx").collect()] == [(10.0, 36.1), (20.0, 36.2)]
    (tmp_path / "m.kml").write_text("<kml><coordinates>-78.5,35.7 -75.3,36.1 -75.4,37.6</coordinates></kml>")
    assert readers.read_footprint(spark, str(tmp_path / "m.kml")).first() == (-78.5, 35.7, -75.3, 37.6)
    (tmp_path / "d.dim").write_text("<Dimap_Document><Image_Interpretation><Spectral_Band_Info><BAND_NAME>VV</BAND_NAME><BAND_RASTER_WIDTH>7</BAND_RASTER_WIDTH><BAND_RASTER_HEIGHT>5</BAND_RASTER_HEIGHT></Spectral_Band_Info></Image_Interpretation></Dimap_Document>")
    assert readers.dimap_bands(spark, str(tmp_path / "d.dim")).first() == ("VV", 7, 5)


def test_band_tiles(spark, tmp_path):
    a = np.arange(35, dtype=">f4").reshape(5, 7)
    (tmp_path / "vv.img").write_bytes(a.tobytes())
    t = readers.read_band_tiles(spark, str(tmp_path / "vv.img"), "ENVI\nsamples = 7\nlines = 5\ndata type = 4\nbyte order = 1\n", side=4)
    got = {(r.tile_row, r.tile_col): np.frombuffer(r.payload, "<f4").reshape(r.height, r.width) for r in t.collect()}
    assert len(got) == 4 and (got[1, 1] == a[4:, 4:]).all() and (got[0, 0] == a[:4, :4]).all()


def test_pins_files_and_tracks(spark, tmp_path):
    (tmp_path / "pins.csv").write_text("#comment\nName\tX:Double\nA\t1.5\n")
    assert readers.read_pins(spark, str(tmp_path / "pins.csv")).first()[0] == "A"
    (tmp_path / "x_y_vv_20230620T230642.tif").write_bytes(b"12")
    f = readers.scene_files(spark, str(tmp_path), "*.tif").first()
    assert f.channel == "vv" and f.length == 2
    (tmp_path / "t.csv").write_text("mmsi,timestamp,point_type,lat,lon\n1,2023-06-20 00:00:00,real,1,2\n")
    assert readers.read_tracks(spark, str(tmp_path / "t.csv")).first().point_type == "real"


def test_config(tmp_path, monkeypatch):
    (tmp_path / "c.json").write_text('{"a": {"b": 1}}')
    monkeypatch.setenv("PELAGOS_SET_A__C", "2")
    c = readers.Config.load(str(tmp_path / "c.json"))
    assert c.get("a.b") == 1 and c.get("a.c") == "2" and c.get("x.y", 5) == 5


def test_json_and_shape(spark, tmp_path):
    df = spark.createDataFrame([(1, 36.0, -76.0, 0.9, 1, 2, 3, 4)], "detect_id long, lat double, lon double, confidence double, bbox_x1 int, bbox_y1 int, bbox_x2 int, bbox_y2 int")
    sinks.write_detections_json(df, str(tmp_path / "j"), {"input_crs": "EPSG:4326"})
    assert spark.read.json(str(tmp_path / "j/detections")).first().bbox == [1, 2, 3, 4] and spark.read.json(str(tmp_path / "j/metadata")).first().total_detections == 1
    raw = sinks.shape_points(df)
    assert struct.unpack(">i", raw[:4])[0] == 9994 and struct.unpack("<dd", raw[-16:]) == (-76.0, 36.0)
    assert sinks.api_features(df).count() == 2
    null = df.withColumn("lat", F.lit(None).cast("double"))
    assert sinks.point_features(null, ["detect_id"]).count() == 0


def test_metadata_tables(spark):
    spark.sql("DROP DATABASE IF EXISTS meta_test CASCADE")
    metadata.create_tables(spark, "meta_test")
    w = spark.createDataFrame([(1, 7, "train"), (2, 7, "val"), (3, 8, "train")], "id long, dataset_id long, split string")
    lab = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "window_id long, value string")
    assert spark.table("meta_test.windows").columns[:3] == ["id", "dataset_id", "image_id"]
    assert [r.value for r in metadata.labels_of(lab, w, 7, ["val"]).collect()] == ["b"]
    assert metadata.by_id(w, 3).first().dataset_id == 8 and metadata.windows_of(w, 7).count() == 2
    spark.sql("DROP DATABASE meta_test CASCADE")


def test_first_report_in_the_file_counts(spark, tmp_path):
    from pelagos.operators import correlate
    head = "MMSI,BaseDateTime,LAT,LON,SOG,COG,Heading,VesselType,Length,Width\n"
    for n in range(3):
        lines = [f"{9007199254740993 + 2 * v},2023-06-20 23:06:4{s},{36 + n + i / 100},-76,5,10,20,70,100,20\n" for v in range(20) for i, s in enumerate((1, 3, 1))]
        (tmp_path / f"part{n}.csv").write_text(head + "".join(lines))
    ais = readers.ais_columns(readers.read_ais(spark, str(tmp_path)))
    rows = correlate.clean_reports(ais, 1687302402000000, 2).collect()  # 23:06:42, as far from 41 as from 43
    assert len(rows) == 20 and {r.lat for r in rows} == {36.0} and {r.mmsi % 2 for r in rows} == {1}


def test_shape_files_of_any_number(spark):
    df = spark.range(25).selectExpr("id AS detect_id", "if(id = 7, null, id * 0.5D) AS lat", "-id * 1.5D AS lon", "concat('ä', id) AS vessel_type").coalesce(1)
    parts = sinks.shape_files(df, most=10).collect()
    assert [r.points for r in parts] == [10, 10, 4]
    r, places = parts[2], [struct.unpack_from("<dd", parts[2].shp, 100 + 28 * i + 12) for i in range(4)]
    assert places == [(-i * 1.5, i * 0.5) for i in range(21, 25)] and struct.unpack_from(">i", r.shp, 24)[0] * 2 == len(r.shp) and struct.unpack_from(">i", r.shx, 24)[0] * 2 == len(r.shx)
    assert struct.unpack_from(">ii", r.shx, 108) == (64, 10) and struct.unpack_from("<I", r.dbf, 4)[0] == 4
    size, row = struct.unpack_from("<HH", r.dbf, 8)
    assert len(r.dbf) == size + 4 * row + 1 and "ä21".encode() in r.dbf and r.dbf[32:41] == b"detect_id"
