"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import gc
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.kryoserializer.buffer.max": "1g",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # written intermediates go once nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app_name: str = "editsieve", **conf: str) -> SparkSession:
    """Session with the project defaults; ``conf`` (dots as ``__``) wins over them."""
    builder = SparkSession.builder.appName(app_name)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is not None:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="editsieve-checkpoint-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


FREE_SECONDS = 20.0  # no more often than this
_freed = 0.0


def free_finished(spark: SparkSession) -> None:
    """Let Spark delete what finished steps shuffled and wrote: it does so once the driver's collector has found their plans.

    A driver with memory to spare collects so seldom that the files of all steps would stay until the end.
    """
    global _freed
    if time.monotonic() - _freed >= FREE_SECONDS:
        gc.collect()  # plans that only cycles here hold
        spark._jvm.System.gc()
        _freed = time.monotonic()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, so that later passes all see the same rows.

    What was written already is not written again.
    """
    if is_written(df):
        return df
    shared_dir(df.sparkSession)
    free_finished(df.sparkSession)
    return as_written(df.checkpoint())


def is_written(df: DataFrame) -> bool:
    return getattr(df, "_written", False)


def as_written(df: DataFrame) -> DataFrame:
    """Mark ``df``, a projection row by row of a written table: it gives the same rows in the same partitions each time."""
    df._written = True
    return df


def query_checkpoint(root: str, query_name: str) -> str:
    """Every streaming query has a checkpoint folder of its own under ``root``."""
    return f"{root.rstrip('/')}/{query_name}"
