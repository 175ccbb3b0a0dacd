"""Services whose batches fail at any step and are repeated, and versions that are read while they are written."""

import pytest
from pyspark.sql import functions as F

from editsieve.operators import bloom, changes as ch, evaluation as ev
from editsieve.plans.events import records, windows_as_seconds
from editsieve.plans.views import changes
from editsieve.sources import versions
from editsieve.streaming import ledger, registry, services, sinks
from tests.test_streams import NOW, SF_DIR, finish, ordered_files, parsed_batch, read

STEPS = ["before outputs", "after clean", "after scored", "before commit", "after commit"]


class Broken(Exception):
    pass


@pytest.fixture(scope="module")
def record_files(spark, tmp_path_factory):
    return ordered_files(records(spark, SF_DIR), str(tmp_path_factory.mktemp("records") / "r"))


@pytest.fixture(scope="module")
def trained(spark):
    return bloom.bloom_build(ch.label_from_flag(changes(spark, SF_DIR, "train")))


def fail_once(monkeypatch, step):
    """Let the third batch fail at ``step``, the first time."""
    left, number = [1], [0]

    def broken(name):
        if name == step and number[0] == 3 and left:
            left.pop()
            raise Broken(step)

    attempt, commit, new = sinks.FileBatches.attempt, ledger.BatchLedger.commit, services.new_attempt

    def named():
        number[0] += 1
        broken("before outputs")
        return new()

    def written(self, batch, name):
        attempt(self, batch, name)
        broken("after scored" if self.path.endswith("/rows") else "after clean")

    def committed(self, *args):
        broken("before commit")
        commit(self, *args)
        broken("after commit")

    monkeypatch.setattr(services, "new_attempt", named)
    monkeypatch.setattr(sinks.FileBatches, "attempt", written)
    monkeypatch.setattr(ledger.BatchLedger, "commit", committed)
    return left


@pytest.mark.parametrize("step", STEPS)
def test_a_repeated_batch_counts_once(spark, record_files, trained, tmp_path, monkeypatch, step):
    filter_path, scored, clean, metrics, cp = (str(tmp_path / n) for n in ("f", "scored", "clean", "metrics", "cp"))
    bloom.bloom_save(trained, filter_path)
    left = fail_once(monkeypatch, step)

    def run():
        query = services.filter_stream(
            read(spark, record_files), filter_path, sinks.file_batches(clean), scored, cp, trigger=NOW
        )
        try:
            query.awaitTermination(300)
        except Exception as wrong:  # the query's own exception names the step
            assert step in str(wrong)

    def report():  # the metrics read on while the service is down
        finish(services.service_metrics(
            spark, scored, cp, "metrics", sinks.upsert_metrics(metrics), watermark="40 days", trigger=NOW
        ))

    run()
    assert not left
    report()
    run()
    report()
    want = bloom.bloom_lookup(ch.require_user(parsed_batch(spark)), trained)
    columns = services.SCORED_COLUMNS
    got = services.scored_rows(spark, scored).select(columns)
    assert got.exceptAll(want.select(columns)).count() == 0 and got.count() == want.count()
    kept = services.written_rows(spark, clean, scored)
    assert kept.count() == want.filter("prediction = 0").count()
    table = windows_as_seconds(ev.derive_metrics(ev.windowed_confusion(want))).select(
        "window_start", "total_observations", "true_positives", "false_positives", "precision"
    )
    live = windows_as_seconds(sinks.latest_metrics(spark, metrics)).select(table.columns)
    assert live.exceptAll(table).count() == 0 and live.count() == table.count()


def test_repeated_metrics_batches_change_nothing(spark, tmp_path):
    path = str(tmp_path / "m")
    one = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS window_start, timestamp'2024-01-01 00:10:00' AS window_end, 1D AS accuracy, "
                    "1D AS precision, 1D AS recall, 1D AS f1_score, 3L AS total_observations, 1L AS true_positives, 0L AS false_positives, 0L AS false_negatives")
    upsert = sinks.upsert_metrics(path)
    upsert(one, 0)
    upsert(one.withColumn("total_observations", F.lit(9).cast("bigint")), 0)
    assert sinks.latest_metrics(spark, path).first().total_observations == 3
    upsert(one.withColumn("total_observations", F.lit(9).cast("bigint")), 1)
    assert [r.total_observations for r in sinks.latest_metrics(spark, path).collect()] == [9]


def accusations(spark, path, users, start):
    rows = spark.createDataFrame([(u, start + k) for k, u in enumerate(users)], "value string, s bigint")
    rows = rows.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.timestamp_seconds("s").alias("timestamp"))
    rows.coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("step", ["registry", "filter", "after filter"])
def test_training_goes_on_where_it_failed(spark, tmp_path, monkeypatch, step):
    source, *paths = (str(tmp_path / n) for n in ("a", "registry", "filter", "cp"))
    accusations(spark, source, ["a", "b"], 1000)
    finish(services.train_filter_stream(read(spark, source), *paths, trigger=NOW))
    accusations(spark, source, ["c"], 2000)
    left, save, retain = [1], bloom.bloom_save, services.retain

    def broken(name):
        if name == step and left:
            left.pop()
            raise Broken(step)

    publish = versions.publish

    def published(df, path, *args, **more):
        if path == paths[0]:
            broken("registry")
        return publish(df, path, *args, **more)

    def saved(*args, **more):
        broken("filter")
        save(*args, **more)
        broken("after filter")

    monkeypatch.setattr(registry, "publish", published)
    monkeypatch.setattr(bloom, "bloom_save", saved)
    monkeypatch.setattr(services, "retain", retain)
    with pytest.raises(Exception):
        finish(services.train_filter_stream(read(spark, source), *paths, trigger=NOW))
    finish(services.train_filter_stream(read(spark, source), *paths, trigger=NOW))
    assert {r.user for r in registry.newest_registry(spark, paths[0]).collect()} == {"a", "b", "c"}
    assert versions.newest_version(spark, paths[0]) == versions.newest_version(spark, paths[1]) == 1
    assert bloom.bloom_load(spark, paths[1]).params.capacity == 3


def test_a_new_checkpoint_goes_on_from_the_newest_version(spark, tmp_path):
    source, registry_path, filter_path = (str(tmp_path / n) for n in ("a", "registry", "filter"))
    for number, users in enumerate((["a"], ["b", "c"])):
        accusations(spark, f"{source}{number}", users, 1000 + 100 * number)
        finish(services.train_filter_stream(
            read(spark, f"{source}{number}"), registry_path, filter_path, str(tmp_path / f"cp{number}"), trigger=NOW
        ))
    assert versions.newest_version(spark, filter_path) == 1
    probe = spark.createDataFrame([("a",), ("b",), ("c",)], "user string")
    found = bloom.bloom_lookup(probe, bloom.bloom_load(spark, filter_path))
    assert found.filter("prediction = 1").count() == 3


def test_a_version_is_read_whole_while_it_is_written_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "f")
    probe = spark.createDataFrame([("a",), ("b",)], "user string")

    def built(*users):
        return bloom.bloom_build(spark.createDataFrame([(u, 1) for u in users], "user string, label int"), 0.0001)

    def flagged(tables):
        return {r.user for r in bloom.bloom_lookup(probe, tables).filter("prediction = 1").collect()}

    bloom.bloom_save(built("a"), path, 5)
    held = bloom.bloom_load(spark, path)
    append = versions._append
    seen = []

    def slow(*args):  # rows are written, the log is not
        seen.append(flagged(bloom.bloom_load(spark, path)))
        append(*args)

    monkeypatch.setattr(versions, "_append", slow)
    bloom.bloom_save(built("b"), path, 5)
    assert seen == [{"a"}] and flagged(bloom.bloom_load(spark, path)) == {"b"} and flagged(held) == {"a"}

    def lost(*args):
        raise Broken

    monkeypatch.setattr(versions, "_append", lost)
    with pytest.raises(Broken):
        bloom.bloom_save(built("a", "b"), path, 6)
    assert bloom.bloom_newest_version(spark, path) == 5 and flagged(bloom.bloom_load(spark, path)) == {"b"}


def test_retention_spares_what_is_leased(spark, tmp_path):
    path = str(tmp_path / "v")
    for n in range(3):
        versions.publish(spark.range(n + 1), path)
    held = versions.lease_newest(spark, path, 1000)
    for n in range(3, 6):
        versions.publish(spark.range(n + 1), path)
    assert versions.retain(spark, path, keep=2) == 3  # 0, 1 and 3; 2 is leased
    assert versions.rows_of(spark, path, "id bigint", held).count() == 3
    assert [versions.read_version(spark, path, "id bigint", n).count() for n in (4, 5)] == [5, 6]
    for n in (0, 2, 3):
        with pytest.raises(ValueError):
            versions.read_version(spark, path, "id bigint", n)
    assert versions.retain(spark, path, keep=2) == 0
    with pytest.raises(ValueError):
        versions.retain(spark, path, keep=0)
    assert versions.lease_newest(spark, str(tmp_path / "none"), 1) is None


def test_await_any_stops_the_others(spark, tmp_path):
    def quiet(name):
        stream = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        return stream.writeStream.format("noop").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()

    def fails(batch, batch_id):
        raise Broken("one query ends")

    first = quiet("first")
    stream = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    stream.writeStream.foreachBatch(fails).option("checkpointLocation", str(tmp_path / "second")).start()
    with pytest.raises(Exception):
        services.await_any(spark)
    assert not first.isActive and not spark.streams.active
