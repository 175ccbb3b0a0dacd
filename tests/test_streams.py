"""Streams against their batch twins, on time-ordered files of the events."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from editsieve.operators import bloom, changes as ch, classifier as cl, evaluation as ev
from editsieve.plans.events import records, windows_as_seconds
from editsieve.plans.views import changes
from editsieve.sources import recorded, topics, versions
from editsieve.streaming import registry, services, sinks

SF_DIR = "/root/testdata/sf0.001"
FILES = 6
NOW = {"availableNow": True}


def ordered_files(df, path, order="timestamp"):
    """Write time-ordered files whose modification times follow the order."""
    df.repartitionByRange(FILES, order).sortWithinPartitions(order).write.parquet(path)
    for number, name in enumerate(sorted(n for n in os.listdir(path) if n.endswith(".parquet"))):
        stamp = time.time() - 1000 + number * 10
        os.utime(f"{path}/{name}", (stamp, stamp))
    return path


@pytest.fixture(scope="module")
def record_files(spark, tmp_path_factory):
    return ordered_files(records(spark, SF_DIR), str(tmp_path_factory.mktemp("records") / "r"))


@pytest.fixture(scope="module")
def accused_files(spark, tmp_path_factory):
    accused = changes(spark, SF_DIR).select(  # every account is accused now and then
        F.lit(None).cast("binary").alias("key"), F.col("user").cast("binary").alias("value"),
        F.timestamp_seconds("timestamp").alias("timestamp"),
    )
    return ordered_files(accused, str(tmp_path_factory.mktemp("accused") / "a"))


def read(spark, path):
    return topics.read_record_files(spark, path, files_per_trigger=1)


def finish(query):
    query.awaitTermination(300)
    assert query.exception() is None
    return query


def parsed_batch(spark):
    return ch.parse_envelope(records(spark, SF_DIR))


def test_collector_equals_batch_and_restarts(spark, record_files, tmp_path):
    out, checkpoints = str(tmp_path / "out"), str(tmp_path / "cp")
    for _ in range(2):  # the second run finds nothing new
        finish(services.collect_stream(read(spark, record_files), out, checkpoints, 0.5, trigger=NOW))
    want = ch.hash_sample(parsed_batch(spark), "user", 0.5)
    got = recorded.scan_changes_csv(spark, out)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    parquet = str(tmp_path / "parquet")
    finish(services.collect_stream(
        read(spark, record_files), parquet, str(tmp_path / "cp2"), 0.5, trigger=NOW, file_format="parquet"
    ))
    assert spark.read.parquet(parquet).count() == want.count()


def test_parse_counts_drops(spark, record_files, tmp_path):
    stream = ch.parse_envelope(read(spark, record_files), observe="parse")
    query = finish(
        stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    seen = [p["observedMetrics"]["parse"] for p in map(json.loads, [p.json for p in query.recentProgress])
            if p["numInputRows"]]
    assert sum(s["records"] for s in seen) == 1000
    assert sum(s["dropped"] for s in seen) == 1000 - parsed_batch(spark).count()


def test_registry_forgets_like_its_batch_twin(spark, accused_files, tmp_path):
    forget = 4 * 3600
    paths = [str(tmp_path / n) for n in ("registry", "filter", "cp")]
    for _ in range(2):
        finish(services.train_filter_stream(
            read(spark, accused_files), *paths, forget_seconds=forget, trigger=NOW
        ))
    bots = changes(spark, SF_DIR).select("user", ch.event_time().alias("timestamp"))
    want = registry.active_accused(bots, forget)
    got = registry.newest_registry(spark, paths[0])
    assert sorted(got.collect()) == sorted(want.collect())
    assert 0 < want.count() < bots.select("user").distinct().count()
    loaded = bloom.bloom_load(spark, paths[1])
    assert loaded.params.capacity == want.count()
    labelled = want.select("user", F.lit(1).alias("label"))
    assert sorted(loaded.words.collect()) == sorted(bloom.bloom_build(labelled).words.collect())
    # a repeated batch changes nothing
    batch = spark.read.parquet(accused_files).select(F.col("value").cast("string").alias("user"), "timestamp")
    owner = next(iter(versions.last_commit(spark, paths[0]).done))
    again = registry.merge_accusations(spark, paths[0], batch, FILES - 1, forget, owner)
    assert sorted(again.collect()) == sorted(want.collect())
    assert versions.newest_version(spark, paths[0]) == FILES - 1


def test_registry_boundary(spark):
    rows = [("kept", 100), ("kept", 40), ("edge", 40), ("gone", 39)]
    accused = spark.createDataFrame(rows, "user string, s bigint").select("user", F.timestamp_seconds("s").alias("timestamp"))
    assert {r.user for r in registry.active_accused(accused, 60).collect()} == {"kept", "edge"}
    assert registry.active_accused(accused.limit(0), 60).count() == 0


def closed_windows(spark, scored, watermark=600):
    last = scored.agg(F.max("timestamp")).first()[0]
    table = windows_as_seconds(ev.derive_metrics(ev.windowed_confusion(scored)))
    return {tuple(r) for r in table.filter(F.col("window_end") <= last - watermark).collect()}


def streamed_windows(spark, path):
    rows = windows_as_seconds(sinks.latest_metrics(spark, path))
    return {r.window_start: r for r in rows.collect()}


def test_filter_service(spark, record_files, tmp_path):
    filter_path, scored_path, clean, metrics = (str(tmp_path / n) for n in ("f", "scored", "clean", "metrics"))
    tables = bloom.bloom_build(ch.label_from_flag(changes(spark, SF_DIR, "train")))
    with pytest.raises(Exception):
        finish(services.filter_stream(
            read(spark, record_files), filter_path, sinks.file_batches(clean), scored_path,
            str(tmp_path / "cp0"), trigger=NOW,
        ))
    bloom.bloom_save(tables, filter_path, 0)
    finish(services.filter_stream(
        read(spark, record_files), filter_path, sinks.file_batches(clean), scored_path,
        str(tmp_path / "cp"), trigger=NOW,
    ))
    want = bloom.bloom_lookup(ch.require_user(parsed_batch(spark)), tables)
    kept = services.written_rows(spark, clean, scored_path)
    assert kept.count() == want.filter("prediction = 0").count()
    first = json.loads(kept.orderBy("value").first().value)
    assert "prediction" not in first and "timestamp" not in first and first["user"]
    finish(services.service_metrics(
        spark, scored_path, str(tmp_path / "cp"), "filter-metrics", sinks.upsert_metrics(metrics),
        watermark="40 days", trigger=NOW,
    ))
    got = streamed_windows(spark, metrics)
    batch = windows_as_seconds(ev.derive_metrics(ev.windowed_confusion(want))).collect()
    assert len(got) == len(batch)
    for r in batch:
        assert got[r.window_start].true_positives == r.true_positives
        assert got[r.window_start].precision == r.precision and got[r.window_start].f1_score == r.f1_score


def test_filter_reload_changes_the_next_batch(spark, record_files, tmp_path):
    filter_path, scored_path = str(tmp_path / "f"), str(tmp_path / "scored")
    everyone = changes(spark, SF_DIR).select("user", F.lit(1).alias("label"))
    bloom.bloom_save(bloom.bloom_build(everyone.limit(0)), filter_path, 0)
    versions = []

    def write(batch, batch_id):
        versions.append((batch_id, batch.count()))
        if batch_id == 2:  # from the next batch on everyone is filtered
            bloom.bloom_save(bloom.bloom_build(everyone), filter_path, 1)

    finish(services.filter_stream(
        read(spark, record_files), filter_path, write, scored_path, str(tmp_path / "cp"),
        reload_seconds=0, trigger=NOW,
    ))
    assert all(n > 0 for b, n in versions if b <= 2) and all(n == 0 for b, n in versions if b > 2)
    assert len(versions) == FILES


def test_late_events_and_watermark(spark, tmp_path):
    path = str(tmp_path / "late")
    base = 1_700_000_400
    batches = [[(base, True, 1), (base + 4000, False, 1)], [(base + 3700, True, 0), (base + 9000, True, 1)], [(base, True, 1)]]
    for number, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "timestamp bigint, bot boolean, prediction int")
        df.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    stream = spark.readStream.schema("timestamp bigint, bot boolean, prediction int").option(
        "maxFilesPerTrigger", 1
    ).parquet(path)
    out = str(tmp_path / "metrics")
    finish(sinks.metrics_sink(
        sinks.metrics_stream(stream), str(tmp_path / "cp"), "late", sinks.upsert_metrics(out), NOW
    ))
    got = streamed_windows(spark, out)
    window = base // 300 * 300
    assert got[window].total_observations == 1  # the event behind the watermark is not counted
    inside = (base + 3700) // 300 * 300
    assert got[inside].false_negatives == 1


def test_memory_sink_and_unknown_sink(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([(60, True, 1)], "timestamp bigint, bot boolean, prediction int").write.parquet(path)
    stream = spark.readStream.schema("timestamp bigint, bot boolean, prediction int").parquet(path)
    finish(sinks.metrics_sink(sinks.metrics_stream(stream), str(tmp_path / "cp"), "in_memory", "memory", NOW))
    assert spark.table("in_memory").count() == 2
    with pytest.raises(ValueError):
        sinks.metrics_sink(sinks.metrics_stream(stream), str(tmp_path / "cp"), "x", "elsewhere")


def test_empty_batches_do_not_train(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0).write.parquet(path)
    calls = []
    stream = spark.readStream.schema("id bigint").parquet(path)
    finish(sinks.foreach_batch_train(
        stream, lambda b, i: calls.append(b.count()), str(tmp_path / "cp"), "train", trigger=NOW
    ))
    spark.range(3).write.mode("append").parquet(path)
    stream = spark.readStream.schema("id bigint").parquet(path)
    finish(sinks.foreach_batch_train(
        stream, lambda b, i: calls.append(b.count()), str(tmp_path / "cp"), "train", trigger=NOW
    ))
    assert calls == [3]


def test_activity_across_batches(spark, record_files, tmp_path):
    stream = services.enrich_activity_stream(ch.parse_envelope(read(spark, record_files)))
    out = str(tmp_path / "out")
    finish(
        stream.select("id", "user", "timestamp", "edits_per_minute").writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    want = ch.enrich_activity(parsed_batch(spark)).select("id", "user", "timestamp", "edits_per_minute")
    last = want.agg(F.max("timestamp")).first()[0]
    closed = want.filter((F.floor(F.col("timestamp") / 60) + 1) * 60 < last - 60)
    got = spark.read.parquet(out)
    assert got.exceptAll(want).count() == 0
    assert closed.exceptAll(got).count() == 0


@pytest.mark.parametrize("exact", [False, True])
def test_detector(spark, record_files, tmp_path, exact):
    vectors = spark.createDataFrame(
        [(w, [float(x)]) for w, x in (("69}", 1), ("89}", -1))], "token string, vector array<double>"
    )
    rows = ch.with_text(changes(spark, SF_DIR)).withColumn("label", (F.col("type") == "error").cast("int"))
    model = cl.fit_classifier(rows, vectors, cl.ClassifierParams(weight_type="balanced"))
    accused, scored = str(tmp_path / "accused"), str(tmp_path / "scored")
    finish(services.detect_bots_stream(
        read(spark, record_files), model, sinks.file_batches(accused), scored, str(tmp_path / "cp"),
        freq=0.5, exact_activity=exact, trigger=NOW,
    ))
    want = model.predict_texts(ch.hash_sample(ch.with_text(parsed_batch(spark)), "text", 0.5))
    rows = services.scored_rows(spark, scored)
    columns = ["id", "timestamp", "user", "bot", "prediction"]
    assert rows.select(columns).exceptAll(want.select(columns)).count() == 0
    missing = want.select(columns).exceptAll(rows.select(columns)).count()
    assert missing == 0 if not exact else missing <= 20
    assert services.written_rows(spark, accused, scored).count() == rows.filter("prediction = 1").count()


def test_record_files_sink(spark, record_files, tmp_path):
    stream = read(spark, record_files).select("key", "value")
    finish(topics.write_record_files(stream, str(tmp_path / "o"), str(tmp_path / "cp"), "archive", NOW))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1000
