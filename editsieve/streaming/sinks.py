"""Sinks of the services: metrics in update mode, training per batch, records per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import with_event_time
from ..operators.evaluation import derive_metrics, windowed_confusion, windows_of_panes
from ..schemas import METRIC_COLUMNS
from ..session import query_checkpoint
from ..sources.versions import is_done, newest_version, publish, read_version
from .ledger import attempt_path, owner_of

BatchFunction = Callable[[DataFrame, int], None]
# How late an event may be to count in its window; state older than that is dropped.
METRICS_WATERMARK = "10 minutes"
METRICS_DDL = (
    "window_start timestamp, window_end timestamp, accuracy double, precision double, "
    "recall double, f1_score double, total_observations bigint, true_positives bigint, "
    "false_positives bigint, false_negatives bigint"
)


def metrics_stream(scored: DataFrame, watermark: str = METRICS_WATERMARK) -> DataFrame:
    """Sliding-window metrics of a scored stream (``timestamp``, ``bot``, ``prediction``)."""
    timed = with_event_time(scored).withWatermark("event_time", watermark)
    counts = windowed_confusion(timed, time=F.col("event_time"))
    return derive_metrics(counts, empty=1.0).select(*METRIC_COLUMNS)


def pane_metrics_stream(panes: DataFrame, watermark: str = METRICS_WATERMARK) -> DataFrame:
    """The same from a stream of counts per slide; lateness is that of the start of a slide."""
    counts = windows_of_panes(panes.withWatermark("pane_start", watermark))
    return derive_metrics(counts, empty=1.0).select(*METRIC_COLUMNS)


def metrics_sink(
    metrics: DataFrame, checkpoint_root: str, name: str, sink: str | BatchFunction = "console",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the metrics in update mode: ``console``, ``memory`` or a function per batch."""
    writer = (
        metrics.writeStream.queryName(name).outputMode("update")
        .option("checkpointLocation", query_checkpoint(checkpoint_root, name))
    )
    if callable(sink):
        writer = writer.foreachBatch(sink)
    elif sink in ("console", "memory"):
        writer = writer.format(sink).option("truncate", False)
    else:
        raise ValueError(f"unsupported metrics sink: {sink}")
    return (writer.trigger(**trigger) if trigger else writer).start()


def upsert_metrics(path: str) -> BatchFunction:
    """A function per batch that keeps the latest row of every window below ``path``.

    A batch that is repeated after its version was committed changes nothing.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark, owner = batch.sparkSession, owner_of(batch)
        if is_done(spark, path, owner, batch_id):
            return
        known = latest_metrics(spark, path)
        both = known.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
        latest = Window.partitionBy("window_start").orderBy(F.desc("_new"))
        kept = both.withColumn("_n", F.row_number().over(latest)).filter("_n = 1")
        publish(kept.select(*METRIC_COLUMNS), path, owner=owner, batch=batch_id)

    return upsert


def latest_metrics(spark, path: str) -> DataFrame:
    return read_version(spark, path, METRICS_DDL, newest_version(spark, path))


def foreach_batch_train(
    df: DataFrame, train: BatchFunction, checkpoint_root: str, name: str, period_seconds: int = 3600,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run ``train`` on every batch that has rows, by default once an hour."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            train(batch, batch_id)

    return (
        df.writeStream.queryName(name).foreachBatch(run)
        .option("checkpointLocation", query_checkpoint(checkpoint_root, name))
        .trigger(**(trigger or {"processingTime": f"{period_seconds} seconds"}))
        .start()
    )


def topic_batches(brokers: str, topic: str) -> BatchFunction:
    """Write each batch of records to a topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("kafka").option("kafka.bootstrap.servers", brokers).option(
            "topic", topic
        ).save()

    return write


class FileBatches:
    """Writes each batch as Parquet, into a folder of the batch or, for a service, of the attempt."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """A repeated batch replaces what it wrote before."""
        batch.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def attempt(self, batch: DataFrame, attempt: str) -> None:
        """Counts once the service's ledger names the attempt."""
        batch.write.parquet(attempt_path(self.path, attempt))


def file_batches(path: str) -> FileBatches:
    return FileBatches(path)
