"""The four services: collect, detect, train the filter, filter."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import bloom, changes as ch
from ..operators.classifier import TextClassifier
from ..session import query_checkpoint
from ..sources.recorded import collect_csv
from ..sources.versions import is_done, lease_newest, retain
from .registry import FORGET_SECONDS, merge_accusations
from .ledger import BatchLedger, new_attempt, owner_of
from .sinks import (
    METRICS_WATERMARK, BatchFunction, FileBatches, foreach_batch_train, metrics_sink, pane_metrics_stream,
)

# Periods and sampling shares of the services.
TRAIN_PERIOD_SECONDS = 3600
RELOAD_SECONDS = 3600
COLLECT_SHARE = 0.2
DETECT_SHARE = 0.2
# A version stays readable for this long after its reader should have looked for a newer one.
LEASE_SECONDS = 600
# Groups that the edits of one user and minute are dealt to in a stream.
ACTIVITY_SALTS = 8

SCORED_COLUMNS = ["id", "timestamp", "user", "bot", "prediction"]


def enrich_activity_stream(changes: DataFrame, watermark: str = "1 minute", salts: int = ACTIVITY_SALTS) -> DataFrame:
    """Edits with their user's edits in the same minute, exact across batches.

    Append mode: an edit comes out once its minute has passed the watermark, so the output is
    late by up to a minute and the watermark. ``enrich_activity`` inside a batch is the variant
    without delay, which counts within the batch only.

    Counts are combined before the shuffle. The edits of one user and minute are dealt to
    ``salts`` groups by a hash of the edit, each of which gets the count, so that a user who
    makes most of the edits is not one task and one state.
    """
    timed = ch.with_event_time(changes, "_event_time").withWatermark("_event_time", watermark)
    counts = timed.groupBy(F.window("_event_time", "1 minute").alias("_minute"), "user").agg(
        F.count(F.lit(1)).alias("edits_per_minute")
    ).select(
        F.col("_minute").alias("_minute_b"), F.col("user").alias("_user_b"), "edits_per_minute",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt_b"),
    )
    salt = F.pmod(F.xxhash64(*changes.columns), F.lit(salts)).cast("int")
    edits = timed.withColumns({"_minute_a": F.window("_event_time", "1 minute"), "_salt_a": salt}).drop("_event_time")
    same = (F.col("user") == F.col("_user_b")) & (F.col("_minute_a") == F.col("_minute_b"))
    joined = edits.join(counts, same & (F.col("_salt_a") == F.col("_salt_b")), "left")
    return ch.fill_missing(joined, {"edits_per_minute": 0}).select(*changes.columns, "edits_per_minute")


def service_ledger(spark: SparkSession, scored_path: str) -> BatchLedger:
    return BatchLedger(spark, f"{scored_path}/ledger")


def scored_rows(spark: SparkSession, scored_path: str) -> DataFrame:
    """Scored events of the committed batches of a service."""
    return service_ledger(spark, scored_path).committed(f"{scored_path}/rows")


def written_rows(spark: SparkSession, path: str, scored_path: str) -> DataFrame:
    """What a service wrote to ``path`` with ``file_batches``, of its committed batches."""
    return service_ledger(spark, scored_path).committed(path)


def _two_sinks(
    source: DataFrame, score, split, write: BatchFunction, scored_path: str, checkpoint_root: str,
    name: str, trigger: dict | None,
) -> StreamingQuery:
    """One query that scores each batch once and feeds two outputs from it, exactly once.

    Both outputs go to folders of this attempt, then the ledger commits the batch. A batch that
    fails before that is written anew, one that is repeated after it is skipped. A function other
    than ``file_batches`` is called again for a batch that failed after the call.
    """
    ledger = service_ledger(source.sparkSession, scored_path)
    keep_scored = FileBatches(f"{scored_path}/rows")

    def run(batch: DataFrame, batch_id: int) -> None:
        owner, attempt = owner_of(batch), new_attempt()
        if ledger.holds(owner, batch_id):
            return
        scored = score(batch).persist()
        try:
            if isinstance(write, FileBatches):
                write.attempt(split(scored), attempt)
            else:
                write(split(scored), batch_id)
            kept = scored.select(*SCORED_COLUMNS)
            keep_scored.attempt(kept, attempt)
            ledger.commit(kept, owner, batch_id, attempt)
        finally:
            scored.unpersist()

    writer = source.writeStream.queryName(name).foreachBatch(run).option(
        "checkpointLocation", query_checkpoint(checkpoint_root, name)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def service_metrics(
    spark: SparkSession, scored_path: str, checkpoint_root: str, name: str, sink="console",
    watermark: str = METRICS_WATERMARK, trigger: dict | None = None,
) -> StreamingQuery:
    """Live metrics of a service from its ledger; the state survives a filter reload."""
    metrics = pane_metrics_stream(service_ledger(spark, scored_path).panes(), watermark)
    return metrics_sink(metrics, checkpoint_root, name, sink, trigger)


def collect_stream(
    records: DataFrame, path: str, checkpoint_root: str, freq: float = COLLECT_SHARE,
    hasher: str = "md5", trigger: dict | None = None, file_format: str = "csv",
) -> StreamingQuery:
    """Record all edits of a share of the accounts."""
    sampled = ch.hash_sample(ch.parse_envelope(records), "user", freq, hasher)
    return collect_csv(sampled, path, checkpoint_root, "collector", trigger, file_format)


class FilterReader:
    """The newest filter version, looked for again after ``reload_seconds`` and leased until then and once more."""

    def __init__(self, spark: SparkSession, path: str, reload_seconds: float = RELOAD_SECONDS):
        self.spark, self.path, self.reload_seconds = spark, path, reload_seconds
        self.version, self.tables, self.checked = None, None, float("-inf")

    def current(self) -> bloom.BloomTables:
        if time.monotonic() - self.checked >= self.reload_seconds:
            newest = lease_newest(self.spark, self.path, 2 * self.reload_seconds + LEASE_SECONDS)
            if newest is not None and (self.version is None or newest.attempt != self.version.attempt):
                self.tables, self.version = bloom.bloom_of_version(self.spark, self.path, newest), newest
            self.checked = time.monotonic()
        if self.tables is None:
            raise ValueError(f"no filter at {self.path}")
        return self.tables


def filter_stream(
    records: DataFrame, filter_path: str, write_clean: BatchFunction, scored_path: str,
    checkpoint_root: str, reload_seconds: float = RELOAD_SECONDS, trigger: dict | None = None,
) -> StreamingQuery:
    """Remove events of accounts in the filter; ``key`` and JSON ``value`` of the rest go on.

    The filter is read per batch, so a retrained version takes effect without a restart. Start
    ``service_metrics`` on ``scored_path`` beside it.
    """
    spark = records.sparkSession
    reader = FilterReader(spark, filter_path, reload_seconds)

    def score(batch: DataFrame) -> DataFrame:
        events = ch.require_user(ch.parse_envelope(batch, keep_key=True))
        return bloom.bloom_lookup(events, reader.current())

    def split(scored: DataFrame) -> DataFrame:
        return ch.repack_json(ch.keep_clean(scored))

    return _two_sinks(
        records, score, split, write_clean, scored_path, checkpoint_root, "filter", trigger
    )


def train_filter_stream(
    accused: DataFrame, registry_path: str, filter_path: str, checkpoint_root: str,
    forget_seconds: int = FORGET_SECONDS, period_seconds: int = TRAIN_PERIOD_SECONDS,
    fpr: float = bloom.DEFAULT_FPR, hasher: str = "md5", trigger: dict | None = None, keep_versions: int = 24,
) -> StreamingQuery:
    """Retrain the filter from all accounts accused within ``forget_seconds``.

    Each batch merges its accusations into the registry and publishes a filter of the accounts
    that still count. Both name the batch that they come from: one that is repeated after a
    failure goes on where it failed, and a new checkpoint, which numbers its batches anew, goes on
    from the newest versions. Older versions than ``keep_versions`` are emptied unless leased.
    """
    spark = accused.sparkSession

    def train(batch: DataFrame, batch_id: int) -> None:
        owner = owner_of(batch)
        if is_done(spark, filter_path, owner, batch_id):
            return
        named = ch.confirmed_bots(batch).select("user", "timestamp")
        active = merge_accusations(spark, registry_path, named, batch_id, forget_seconds, owner)
        labelled = active.select("user", F.lit(1).alias("label"))
        bloom.bloom_save(bloom.bloom_build(labelled, fpr, hasher), filter_path, owner=owner, batch=batch_id)
        for path in (registry_path, filter_path):
            retain(spark, path, keep_versions)

    return foreach_batch_train(
        accused, train, checkpoint_root, "filter-training", period_seconds, trigger
    )


def detect_bots_stream(
    records: DataFrame, classifier: TextClassifier, write_accused: BatchFunction, scored_path: str,
    checkpoint_root: str, freq: float = DETECT_SHARE, exact_activity: bool = False,
    hasher: str = "md5", trigger: dict | None = None,
) -> StreamingQuery:
    """Classify a share of the edit texts; user names of accused edits go on as ``value``.

    Activity is counted on all edits, before sampling: within the batch, or with
    ``exact_activity`` across batches at the price of a delay. Start ``service_metrics`` on
    ``scored_path`` beside it.
    """
    if not 0 <= freq <= 1:
        raise ValueError(f"sampling frequency must be between 0 and 1: {freq}")
    source = ch.parse_envelope(records)
    if exact_activity:
        source = enrich_activity_stream(source)

    def score(batch: DataFrame) -> DataFrame:
        edits = batch if exact_activity else ch.enrich_activity(batch)
        sampled = ch.hash_sample(ch.with_text(edits), "text", freq, hasher)
        return classifier.predict_texts(sampled)

    return _two_sinks(
        source, score, ch.keep_accused, write_accused, scored_path, checkpoint_root, "detector", trigger
    )


def await_any(spark: SparkSession) -> None:
    """Wait until any query ends, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for running in spark.streams.active:
            running.stop()
