import datetime as dt

from pelagos.plans.adapters import T_US
from pelagos.streaming import ais


def source(spark, tmp_path):
    t = dt.datetime(2024, 1, 15, 12)
    rows = [(7, t, 36.0, -76.0, 5.0), (7, t, 36.0, -76.0, 5.0), (7, t + dt.timedelta(minutes=5), 36.1, -76.0, 6.0), (8, t, 36.5, -76.0, 1.0), (7, t - dt.timedelta(minutes=9), 35.0, -76.0, 9.0)]
    spark.createDataFrame(rows, "mmsi long, ts timestamp, lat double, lon double, sog double").coalesce(1).write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema("mmsi long, ts timestamp, lat double, lon double, sog double").parquet(str(tmp_path / "in"))


def drain(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name).collect()


def test_deduplicated(spark, tmp_path):
    assert len(drain(ais.deduplicated(source(spark, tmp_path)), "dedup", "append")) == 4


def test_counts_per_window(spark, tmp_path):
    rows = drain(ais.counts_per_window(source(spark, tmp_path)), "counts", "update")
    assert {(r.mmsi, r.window.start.hour): r.reports for r in rows} == {(7, 12): 3, (7, 11): 1, (8, 12): 1}


def test_last_position(spark, tmp_path):
    rows = drain(ais.last_position(source(spark, tmp_path)), "last", "update")
    assert {r.mmsi: r.lat for r in rows} == {7: 36.1, 8: 36.5}


def test_matched_batches(spark, tmp_path):
    s = source(spark, tmp_path).selectExpr("xxhash64(mmsi, ts) AS seq", "mmsi", "unix_micros(ts) AS us", "lat", "lon", "sog", "0D AS cog", "0D AS heading", "100D AS length", "20D AS width", "70 AS vtype")
    det = spark.createDataFrame([(1, 36.0, -76.0, 0.9, 100.0, 20.0, 5.0, "cargo", 0.0)], "detect_id long, lat double, lon double, confidence double, vessel_length_m double, vessel_width_m double, vessel_speed_k double, vessel_type string, heading_degrees double")
    got = []
    q = ais.match_batches(s, det, T_US, lambda df, n: got.extend(df.collect())).start()
    q.processAllAvailable()
    q.stop()
    assert got and got[0].matched_mmsi == 7
