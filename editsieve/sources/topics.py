"""Topic source and sink. Only this module names the connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..schemas import RECORD_SCHEMA
from ..session import query_checkpoint


def read_topic(
    spark: SparkSession, brokers: str, topic: str, starting: str = "latest", **options
) -> DataFrame:
    """Stream of one topic's records (``key``, ``value``, ``timestamp`` and connector columns)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    for name, value in options.items():  # e.g. maxOffsetsPerTrigger, minPartitions
        reader = reader.option(name, value)
    return reader.load()


def read_record_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of recorded topic records in Parquet, with the same columns as ``read_topic``."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _check_record(df: DataFrame) -> DataFrame:
    extra = set(df.columns) - {"key", "value"}
    if extra or "value" not in df.columns:
        raise ValueError(f"a topic takes key and value, not {df.columns}")
    return df


def write_topic(
    df: DataFrame, brokers: str, topic: str, checkpoint_root: str, name: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append ``key``/``value`` or ``value`` rows to a topic, with a checkpoint of its own."""
    writer = (
        _check_record(df).writeStream.format("kafka").queryName(name).outputMode("append")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .option("checkpointLocation", query_checkpoint(checkpoint_root, name))
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def write_record_files(
    df: DataFrame, path: str, checkpoint_root: str, name: str, trigger: dict | None = None
) -> StreamingQuery:
    """The same records as Parquet files: an archive of a topic."""
    writer = (
        _check_record(df).writeStream.format("parquet").queryName(name).outputMode("append")
        .option("path", path)
        .option("checkpointLocation", query_checkpoint(checkpoint_root, name))
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
