"""Library calls that take the place of the detection service and the command-line scripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pelagos.operators import correlate as K
from pelagos.operators import filters as L
from pelagos.operators.spatial import avoid_filter
from pelagos.session import materialize
from pelagos.sources import readers, sinks


def detections(spark: SparkSession, path: str, confidence: float = 0.3, avoid: str | None = None, old_layout: bool = False) -> DataFrame:
    """Detections of a file: filtered by quality, without those at locations to avoid."""
    det = L.quality_filter(readers.read_detections(spark, path, old_layout), confidence)
    return avoid_filter(det, readers.read_avoid(spark, avoid)) if avoid else det


def analyse(spark: SparkSession, detections_path: str, ais_path: str, t_us: int, out: str, options: K.Options = K.Options()) -> DataFrame:
    """The whole run: read, correlate, write results as CSV, GeoJSON and a summary."""
    det = readers.read_detections(spark, detections_path)
    ais = readers.ais_columns(readers.read_ais(spark, ais_path, drop_incomplete=True))
    results = materialize(K.correlate(det, ais, t_us, options), "results")
    sinks.write_csv(sinks.correlation_csv(results), f"{out}/correlation")
    sinks.correlation_features(results, options.mode == "compat").select("feature").write.mode("overwrite").text(f"{out}/geojson")
    summary = sinks.run_summary(results)
    summary.write.mode("overwrite").text(f"{out}/summary")
    return results
