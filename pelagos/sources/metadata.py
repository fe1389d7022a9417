"""Imagery metadata: tables, lookups and their definition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = {
    "datasets": "id BIGINT, collection_id BIGINT, name STRING, task STRING, categories STRING",
    "images": "id BIGINT, uuid STRING, name STRING, format STRING, channels STRING, width INT, height INT, preprocessed BOOLEAN, hidden BOOLEAN, bounds STRING, time TIMESTAMP_NTZ, projection STRING, column_offset BIGINT, row_offset BIGINT, zoom INT",
    "windows": "id BIGINT, dataset_id BIGINT, image_id BIGINT, row BIGINT, column BIGINT, height INT, width INT, hidden BOOLEAN, split STRING",
    "labels": "id BIGINT, window_id BIGINT, row BIGINT, column BIGINT, height INT, width INT, extent STRING, value STRING, properties STRING",
    "detections": "id BIGINT, image_id BIGINT, lat DOUBLE, lon DOUBLE, confidence DOUBLE, metadata STRING",
}


def create_tables(spark: SparkSession, database: str) -> None:
    """The tables as Parquet; windows and labels are bucketed by their foreign key, which takes
    the place of the indexes."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    keys = {"windows": "dataset_id", "labels": "window_id"}
    for name, cols in TABLES.items():
        by = f" CLUSTERED BY ({keys[name]}) INTO 16 BUCKETS" if name in keys else ""
        quoted = ", ".join(f"`{c.split()[0]}` {c.split()[1]}" for c in cols.split(", "))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({quoted}) USING parquet{by}")


def by_id(df: DataFrame, key: int) -> DataFrame:
    return df.filter(F.col("id") == key)


def windows_of(windows: DataFrame, dataset_id: int, splits: list[str] | None = None) -> DataFrame:
    out = windows.filter(F.col("dataset_id") == dataset_id)
    return out.filter(F.col("split").isin(splits)) if splits else out


def labels_of(labels: DataFrame, windows: DataFrame, dataset_id: int, splits: list[str] | None = None) -> DataFrame:
    return labels.join(windows_of(windows, dataset_id, splits).select(F.col("id").alias("window_id")), "window_id", "left_semi")
