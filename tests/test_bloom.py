"""Sizing, no false negatives, both ways of lookup, versions."""

import pytest
from pyspark.sql import functions as F

from editsieve.operators import bloom


def users(spark, names):
    return spark.createDataFrame([(n, 1) for n in names], "user string, label int")


def test_published_sizing(spark):
    params = bloom.bloom_params(users(spark, [f"bot{i}" for i in range(73)]))
    assert (params.size, params.hash_count, params.capacity) == (349, 3, 73)


def test_sizing_of_nothing_and_one(spark):
    nothing = bloom.bloom_build(users(spark, []).limit(0))
    assert (nothing.params.size, nothing.params.hash_count) == (1, 1)
    probe = spark.createDataFrame([("a",), (None,)], "user string")
    assert [r.prediction for r in bloom.bloom_lookup(probe, nothing).collect()] == [0, 0]
    one = bloom.bloom_build(users(spark, ["a"]))
    assert (one.params.size, one.params.hash_count) == (4, 2)


def test_inverse_sizing(spark):
    params = bloom.bloom_params_from_size(spark, 349, 3)
    assert params.capacity == 80 and 0.12 < params.false_positive_rate < 0.13


@pytest.mark.parametrize("hasher", ["md5", "xxhash64"])
@pytest.mark.parametrize("broadcast_words", [10**6, 0])
def test_no_false_negatives_and_rate(spark, hasher, broadcast_words):
    members = [f"бот-{i}" for i in range(500)]
    tables = bloom.bloom_build(users(spark, members + [None]), 0.05, hasher)
    probe = spark.createDataFrame(
        [(n,) for n in members * 2 + [f"new{i}" for i in range(4000)] + [None]], "user string"
    )
    rows = bloom.bloom_lookup(probe, tables, broadcast_words=broadcast_words).collect()
    assert len(rows) == 5001
    assert all(r.prediction == 1 for r in rows if r.user and r.user.startswith("бот"))
    assert [r.prediction for r in rows if r.user is None] == [0]
    false = sum(r.prediction for r in rows if r.user and r.user.startswith("new"))
    assert 0.02 < false / 4000 < 0.09
    rate = bloom.bloom_measured_fpr(probe, users(spark, members), tables).first()
    assert rate.unseen_keys == 4001 - 1 and rate.measured_fpr == pytest.approx(false / 4000)


def test_both_lookups_agree(spark):
    tables = bloom.bloom_build(users(spark, [f"b{i}" for i in range(50)]), 0.3)
    probe = spark.range(3000).select(F.concat(F.lit("b"), F.col("id") % 700).alias("user"), "id")
    small = bloom.bloom_lookup(probe, tables).collect()
    large = bloom.bloom_lookup(probe, tables, broadcast_words=0).collect()
    assert sorted(small) == sorted(large)


def test_lookup_has_no_shuffle_and_no_python(spark):
    tables = bloom.bloom_build(users(spark, [f"b{i}" for i in range(50)]))
    probe = spark.range(10).select(F.col("id").cast("string").alias("user"))
    plan = bloom.bloom_lookup(probe, tables)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in above and "Python" not in plan
    assert plan.count("BroadcastHashJoin") >= tables.params.hash_count


def test_bits_and_health(spark):
    tables = bloom.bloom_build(users(spark, [f"b{i}" for i in range(73)]))
    bits = [r.bit for r in bloom.bloom_bits(tables.words).collect()]
    assert len(set(bits)) == len(bits) and 0 <= min(bits) and max(bits) < 349
    health = bloom.bloom_health(tables).first()
    assert health.set_bits == len(bits) and health.at_capacity
    assert health.fill_ratio == pytest.approx(len(bits) / 349)


def test_versions(spark, tmp_path):
    path = str(tmp_path / "filter")
    assert bloom.bloom_newest_version(spark, path) is None
    with pytest.raises(ValueError):
        bloom.bloom_load(spark, path)
    first = bloom.bloom_build(users(spark, ["a", "b"]))
    bloom.bloom_save(first, path, 1)
    bloom.bloom_save(bloom.bloom_build(users(spark, ["c"] * 3)), path, 2)
    assert bloom.bloom_newest_version(spark, path) == 2
    loaded = bloom.bloom_load(spark, path, 1)
    assert loaded.params == first.params
    assert sorted(loaded.words.collect()) == sorted(first.words.collect())
    empty = bloom.bloom_reset(spark, loaded.params)
    bloom.bloom_save(empty, path, 3)
    again = bloom.bloom_load(spark, path)
    probe = spark.createDataFrame([("a",), ("c",)], "user string")
    assert [r.prediction for r in bloom.bloom_lookup(probe, again).collect()] == [0, 0]


def test_wrong_filters_are_refused(spark, tmp_path):
    path = str(tmp_path / "filter")
    tables = bloom.bloom_build(users(spark, ["a", "b"]))
    outside = spark.createDataFrame([(10**6, 1)], "word bigint, bits bigint")
    bloom.bloom_save(bloom.BloomTables(tables.params, outside), path, 1)
    with pytest.raises(ValueError):
        bloom.bloom_load(spark, path)
    with pytest.raises(ValueError):
        bloom.BloomParams(0, 1, 1, 0.1).validate()
    with pytest.raises(ValueError):
        bloom.BloomParams(8, 1, 1, 0.1, 0, "other").validate()


def test_membership(spark):
    tables = bloom.bloom_build(users(spark, ["a", "b"]), 0.0001)
    rows = spark.createDataFrame([("a",), ("z",), (None,)], "user string")
    assert [r.user for r in bloom.membership_filter(rows, tables, keep_members=True).collect()] == ["a"]
    assert [r.user for r in bloom.membership_filter(rows, tables).collect()] == ["z", None]
    listed = users(spark, ["a", "b"])
    assert [r.user for r in bloom.exact_membership_filter(rows, listed).collect()] == ["z", None]
