"""Recorded changes: CSV or Parquet folders, merging them, replaying them in time order."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.hashing import unit_uniform
from ..operators.numbering import running_sum
from ..schemas import CHANGE_SCHEMA
from ..session import query_checkpoint

# One set of options for writers and readers, so that quotes, line breaks and blanks come back
# as they were. An empty string reads as null, as it does from files of other origin.
CSV_OPTIONS = {
    "header": True, "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
MULTILINE = CSV_OPTIONS | {"multiLine": True}
# Fixed value: mean gap between replayed events.
REPLAY_SCALE_MS = 10.0


def collect_csv(
    df: DataFrame, path: str, checkpoint_root: str, name: str = "collector",
    trigger: dict | None = None, file_format: str = "csv",
) -> StreamingQuery:
    """Append a stream to a folder, by default once a minute, as CSV with header or Parquet."""
    if file_format not in ("csv", "parquet"):
        raise ValueError(f"unsupported format: {file_format}")
    writer = (
        df.writeStream.format(file_format).queryName(name).outputMode("append")
        .option("path", path)
        .option("checkpointLocation", query_checkpoint(checkpoint_root, name))
        .trigger(**(trigger or {"processingTime": "1 minute"}))
    )
    return (writer.options(**CSV_OPTIONS) if file_format == "csv" else writer).start()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**CSV_OPTIONS).csv(path)


def scan_changes_csv(spark: SparkSession, path: str) -> DataFrame:
    """Recorded changes with the fixed schema: no inference pass over the folder.

    Texts may hold line breaks, so a file is read by one task; the collector keeps files small.
    """
    return spark.read.schema(CHANGE_SCHEMA).options(**MULTILINE).csv(path)


def scan_quoted_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A quoted multi-line CSV; types are inferred unless a schema saves that pass."""
    reader = spark.read.options(**MULTILINE)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def merge_folder(spark: SparkSession, path: str, out: str | None = None, schemas: dict | None = None,
                 one_file: bool = False) -> DataFrame:
    """All CSV files of a folder as one table, columns matched by name, missing ones null.

    Files are grouped by their header line, so that each group is one scan however many files
    it has. ``schemas`` may give column types by name; other columns stay text.
    """
    listing = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    lines = listing.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("place")
    ).filter(F.col("_metadata.file_block_start") == 0)
    headers = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    # one row per file, which the listing of the folder holds on the driver anyway
    groups = headers.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    if not groups:
        raise ValueError(f"no CSV files in {path}")
    merged = None
    for group in sorted(groups, key=lambda row: row["header"]):
        # metadata gives paths percent-encoded, the reader takes them as they are
        part = spark.read.options(**MULTILINE).csv([unquote(file) for file in group["files"]])
        for column, kind in (schemas or {}).items():
            if column in part.columns:
                part = part.withColumn(column, F.col(f"`{column}`").cast(kind))
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    if out is not None:
        write_csv(merged.coalesce(1) if one_file else merged, out)
    return merged


def replay_changes(
    df: DataFrame, scale_ms: float = REPLAY_SCALE_MS, partitions: int | None = None
) -> DataFrame:
    """Recorded changes in time order as JSON with the time at which each is to be sent.

    Gaps between events are exponential with mean ``scale_ms``, drawn from the event id, so a
    replay can be repeated. ``arrival_us`` counts from the first event, which is sent at 0.
    """
    gap = F.round(-F.log(F.lit(1.0) - unit_uniform(F.col("id").cast("string"))) * (scale_ms * 1000))
    packed = df.select(
        "timestamp", "id", gap.cast("bigint").alias("gap_us"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"),
    )
    timed = running_sum(packed, "gap_us", ["timestamp", "id"], "_sent", partitions)
    # the gap follows its event, so an event waits for the gaps before it
    return timed.withColumn("arrival_us", F.col("_sent") - F.col("gap_us")).drop("_sent")


def write_replay_files(replay: DataFrame, path: str, files: int) -> None:
    """Time-ordered files of records; a file stream reads them one per trigger."""
    records = replay.select(
        F.col("id").cast("string").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.timestamp_seconds("timestamp").alias("timestamp"),
        "arrival_us",
    )
    records.repartitionByRange(files, "arrival_us").sortWithinPartitions("arrival_us").drop(
        "arrival_us"
    ).write.parquet(path)

