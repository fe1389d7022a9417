"""Session and shared-folder helpers used by every subpackage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app: str = "pelagos", cores: str = "8", shuffle: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PELAGOS_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by spark.checkpoint.dir.

    Only where the session names none and has one machine (tests, local mode) a temporary folder
    is set; on a cluster it would be another one on each machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        held = getattr(spark.sparkContext, "_pelagos_shared", None)
        folder = held or "file://" + tempfile.mkdtemp(prefix="pelagos-")
        spark.sparkContext._pelagos_shared = folder
    return folder.rstrip("/")


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Shuffle files of the actions inside go when these end: nothing reads them later."""
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN_UP, before)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back: cuts the lineage,
    survives lost executors and computes df a single time."""
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._pelagos_path = path
    return out


def keep(df: DataFrame) -> DataFrame:
    """df computed once and held in executors' memory and disks. What a lost executor held is
    computed again from its lineage; materialize() is for long lineages and for large tables."""
    return counted(df)[0]


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """keep(), and the number of rows."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    with _shuffles_dropped(df.sparkSession):
        return df, df.count()


def cut(df: DataFrame, tag: str, per_file: int = 200_000) -> DataFrame:
    """materialize() into few files: computed in parallel, counted, then written with about
    per_file rows a file. For small tables that are read many times, as in loops."""
    return put_down(*counted(df), tag, per_file)


def put_down(held: DataFrame, n: int, tag: str, per_file: int = 200_000) -> DataFrame:
    """What counted() gave, written and no longer held."""
    out = materialize(held.coalesce(max(1, -(-n // per_file))), tag)
    release(held)
    return out


def release(*dfs: DataFrame) -> None:
    """Let go of what keep() holds; delete what materialize() wrote, once what was made of it is
    there."""
    for df in dfs:
        if not hasattr(df, "_pelagos_path"):
            df.unpersist()
            continue
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._pelagos_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long_rows(df: DataFrame, rows: int = 1000) -> DataFrame:
    """df, whose rows hold whole texts: batches for Python workers get fewer rows than the default
    of 10 000, which bounds what a task keeps in the JVM's buffers and in its worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df
