"""Runs of the services: the events are replayed as files in the order of time, and what a run leaves is a table.

A run takes what is there and ends. Its files, checkpoints and results are in a new folder below the shared one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as ft
from ..operators import bloom, changes as ch, classifier as cl
from ..sources import recorded, topics
from ..streaming import registry, services, sinks
from .events import _FLAGS_SQL, _TEXT_SQL, metrics_sql, records, scratch, windows_as_seconds, windows_sql
from .filters import _FILTER_SQL, trained
from .registry import query
from .texts import token_vectors
from .views import SPLIT_SECONDS, changes, md5_sql, with_changes

SLICES = 4
NOW = {"availableNow": True}


def replayed(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Topic records as a stream of ``SLICES`` batches in the order of time, each of about the same size."""
    seconds = F.unix_seconds("timestamp")
    cuts = rows.agg(F.percentile_approx(seconds, [k / SLICES for k in range(1, SLICES)])).first()[0] or []
    edges = [None, *cuts, None]
    for low, high in zip(edges[:-1], edges[1:], strict=True):  # one write after another gives the order
        some = rows
        if low is not None:
            some = some.filter(seconds > low)
        if high is not None:
            some = some.filter(seconds <= high)
        some.coalesce(1).write.mode("append").parquet(path)
    return topics.read_record_files(spark, path, files_per_trigger=1)


def finished(running: StreamingQuery) -> None:
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()


@query("S2 S4 T12", with_changes(f"""
SELECT id, "timestamp", "user", bot, type, title, comment, server_name, meta FROM ch
WHERE id % 11 <> 0 AND ({md5_sql('"user"')} % 1000) / 1000.0 < 0.2"""))
def collect_stream(spark, sf_dir):
    """All edits of a share of the accounts, recorded as CSV and read back."""
    path = scratch(spark, "collected")
    stream = replayed(spark, records(spark, sf_dir), f"{path}/records")
    finished(services.collect_stream(stream, f"{path}/out", f"{path}/checkpoints", trigger=NOW))
    return recorded.scan_changes_csv(spark, f"{path}/out").select(
        "id", "timestamp", "user", "bot", "type", "title", "comment", "server_name", "meta"
    )


@query("S2 S5", with_changes("""
SELECT "user" AS "key", count(*) AS records FROM ch GROUP BY 1"""))
def archive_stream(spark, sf_dir):
    """Topic records kept as files."""
    path = scratch(spark, "archived")
    stream = replayed(spark, records(spark, sf_dir), f"{path}/records").select("key", "value")
    finished(topics.write_record_files(stream, f"{path}/out", f"{path}/checkpoints", "archive", NOW))
    kept = spark.read.parquet(f"{path}/out")
    return kept.groupBy(F.col("key").cast("string").alias("key")).agg(F.count("*").alias("records"))


def _filtered(spark, sf_dir):
    """Folder of a run of the filter service over the second half of the events."""
    path = scratch(spark, "filtered")
    bloom.bloom_save(trained(spark, sf_dir), f"{path}/filter")
    stream = replayed(spark, records(spark, sf_dir, "validation"), f"{path}/records")
    finished(services.filter_stream(
        stream, f"{path}/filter", sinks.file_batches(f"{path}/clean"), f"{path}/scored", f"{path}/checkpoints",
        trigger=NOW,
    ))
    return path


_STREAMED_SQL = f"{_FILTER_SQL}, streamed AS (SELECT * FROM looked_up WHERE id % 11 <> 0)"


@query("S7 T6 T7 T10", with_changes(f"""{_STREAMED_SQL}
SELECT id, "user", "user" AS "key", "timestamp" IS NULL AS has_timestamp FROM streamed WHERE prediction = 0"""))
def filter_stream(spark, sf_dir):
    """Records of the accounts that are not in the filter, as they go on to the next topic."""
    path = _filtered(spark, sf_dir)
    kept = services.written_rows(spark, f"{path}/clean", f"{path}/scored")
    return kept.select(
        F.get_json_object("value", "$.id").cast("bigint").alias("id"), F.get_json_object("value", "$.user").alias("user"),
        F.col("key").cast("string").alias("key"), F.get_json_object("value", "$.timestamp").isNotNull().alias("has_timestamp"),
    )


@query("S6 T2 T3 T7 T8", with_changes(f"""{_STREAMED_SQL},
flags AS (SELECT *, {_FLAGS_SQL} FROM streamed), windows AS ({windows_sql('flags')})
SELECT *, {metrics_sql(1)} FROM windows"""))
def filter_stream_metrics(spark, sf_dir):
    """Live metrics of the filter service: the last state of every window."""
    path = _filtered(spark, sf_dir)
    finished(services.service_metrics(
        spark, f"{path}/scored", f"{path}/checkpoints", "metrics", sinks.upsert_metrics(f"{path}/metrics"), trigger=NOW
    ))
    return windows_as_seconds(sinks.latest_metrics(spark, f"{path}/metrics"))


_FORGET = 3 * 86400
_ACTIVE_SQL = f""", seen AS (
  SELECT "user", max("timestamp") AS last_accused FROM ch WHERE bot GROUP BY 1),
active AS (SELECT * FROM seen WHERE last_accused >= (SELECT max(last_accused) FROM seen) - {_FORGET})"""


def _retrained(spark, sf_dir):
    path = scratch(spark, "retrained")
    accused = changes(spark, sf_dir).filter("bot").select(
        F.lit(None).cast("binary").alias("key"), F.col("user").cast("binary").alias("value"),
        F.timestamp_seconds("timestamp").alias("timestamp"),
    )
    stream = replayed(spark, accused, f"{path}/accused")
    finished(services.train_filter_stream(
        stream, f"{path}/registry", f"{path}/filter", f"{path}/checkpoints", _FORGET, trigger=NOW
    ))
    return path


@query("P12 T4", with_changes(f'{_ACTIVE_SQL} SELECT "user", last_accused FROM active'))
def forgetting_registry_stream(spark, sf_dir):
    """Accounts that still count after all batches of accusations."""
    known = registry.newest_registry(spark, f"{_retrained(spark, sf_dir)}/registry")
    return known.select("user", F.unix_seconds("last_accused").alias("last_accused"))


_RETRAINED_SQL = _FILTER_SQL.replace(
    f'train AS (SELECT DISTINCT "user" FROM ch WHERE bot AND "timestamp" < {SPLIT_SECONDS})',
    f'{_ACTIVE_SQL.strip(", ")}, train AS (SELECT "user" FROM active)',
)


@query("S7 T4 T5 T11", with_changes(f"{_RETRAINED_SQL} SELECT bit FROM bits"))
def train_filter_stream(spark, sf_dir):
    """Bits of the newest filter that the retraining service published."""
    return bloom.bloom_bits(bloom.bloom_load(spark, f"{_retrained(spark, sf_dir)}/filter").words)


_WEIGHTS = (1.0, -1.0, 0.5, -0.5)
_DETECTED_SQL = rf""",
sampled AS (SELECT *, {_TEXT_SQL} AS text FROM ch
  WHERE id % 11 <> 0 AND ({md5_sql(_TEXT_SQL)} % 1000) / 1000.0 < 0.5),
tokens AS (SELECT text, unnest(regexp_extract_all(text, '\S+')) AS token FROM (SELECT DISTINCT text FROM sampled)),
embedded AS (SELECT text, {', '.join(
    f"avg({md5_sql(chr(39) + str(i) + ':' + chr(39) + ' || token')} / 4294967296.0) AS e{i}" for i in range(4))}
  FROM tokens GROUP BY text),
scored AS (SELECT s.*, CASE WHEN {' + '.join(f'e{i} * {w}' for i, w in enumerate(_WEIGHTS))} > 0 THEN 1 ELSE 0 END AS prediction
  FROM sampled s LEFT JOIN embedded e USING (text))"""


def _detected(spark, sf_dir):
    path = scratch(spark, "detected")
    texts = ch.with_text(changes(spark, sf_dir)).select("id", ft.whitespace_tokens(F.col("text")).alias("tokens"))
    model = cl.LinearTextClassifier(_WEIGHTS, 0.0, token_vectors(texts))
    stream = replayed(spark, records(spark, sf_dir), f"{path}/records")
    finished(services.detect_bots_stream(
        stream, model, sinks.file_batches(f"{path}/accused"), f"{path}/scored", f"{path}/checkpoints", freq=0.5, trigger=NOW
    ))
    return path


@query("P5 T7 T9", with_changes(f"""{_DETECTED_SQL}
SELECT "user" AS "value", count(*) AS accusations FROM scored WHERE prediction = 1 GROUP BY 1"""))
def detect_bots_stream(spark, sf_dir):
    """How often each account was accused, as written to the topic of the accused."""
    path = _detected(spark, sf_dir)
    accused = services.written_rows(spark, f"{path}/accused", f"{path}/scored")
    return accused.groupBy("value").agg(F.count("*").alias("accusations"))


@query("J1 T1 T3 T9", with_changes(f"""{_DETECTED_SQL},
flags AS (SELECT *, {_FLAGS_SQL} FROM scored), windows AS ({windows_sql('flags')})
SELECT *, {metrics_sql(1)} FROM windows"""))
def detect_bots_stream_metrics(spark, sf_dir):
    path = _detected(spark, sf_dir)
    finished(services.service_metrics(
        spark, f"{path}/scored", f"{path}/checkpoints", "metrics", sinks.upsert_metrics(f"{path}/metrics"), trigger=NOW
    ))
    return windows_as_seconds(sinks.latest_metrics(spark, f"{path}/metrics"))


@query("J1 T1 T3", with_changes("""
, counted AS (SELECT id, "user", "timestamp", count(*) OVER (PARTITION BY "user", "timestamp" // 60) AS edits_per_minute
  FROM ch WHERE id % 11 <> 0)
SELECT * FROM counted WHERE ("timestamp" // 60 + 1) * 60 < (SELECT max("timestamp") FROM counted) - 60"""))
def enrich_activity_stream(spark, sf_dir):
    """Edits of the minutes that the watermark has closed, with their user's edits in the same minute."""
    path = scratch(spark, "activity")
    stream = ch.parse_envelope(replayed(spark, records(spark, sf_dir), f"{path}/records"))
    rows = services.enrich_activity_stream(stream).select("id", "user", "timestamp", "edits_per_minute")
    finished(
        rows.writeStream.format("parquet").option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoints").trigger(**NOW).start()
    )
    last = F.lit(changes(spark, sf_dir).filter("id % 11 != 0").agg(F.max("timestamp")).first()[0] or 0)
    out = spark.read.schema("id bigint, user string, timestamp bigint, edits_per_minute bigint").parquet(f"{path}/out")
    return out.filter((F.floor(F.col("timestamp") / 60) + 1) * 60 < last - 60)
