"""Lookups that are bounded in bytes, and a hot user and minute on a stream."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from editsieve.operators import changes as ch, skew
from editsieve.streaming import services
from tests.test_streams import NOW, finish


def test_tables_are_measured_in_bytes(spark):
    long = "x" * 1000
    rows = [
        (k, long, [1.0] * 100, [long, None], (long, k), {long: "é" * 500}, bytearray(b"y" * 1000), Vectors.dense([0.125] * 100))
        for k in range(10)
    ]
    table = spark.createDataFrame(
        rows[:0], "id long, s string, a array<double>, t array<string>, u struct<x: string, y: long>, m map<string,string>, b binary"
    )
    assert skew.fits(table, 5, 1)
    table = spark.createDataFrame(
        [r[:7] for r in rows], "id long, s string, a array<double>, t array<string>, u struct<x: string, y: long>, m map<string,string>, b binary"
    )
    size = 10 * (16 + 8 + 1000 + 800 + 1000 + 1008 + 2000 + 1000)
    assert skew.fits(table, 10, size) and not skew.fits(table, 10, size - 1) and not skew.fits(table, 9, size)
    vectors = spark.createDataFrame([(r[7],) for r in rows], ["v"])
    assert not skew.fits(vectors, 10, 3000) and skew.fits(vectors, 10, 30_000)
    assert skew.fits(spark.createDataFrame([(None, None)], "s string, a array<string>"), 1, 16)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookups_beyond_the_bytes_give_the_same(spark, monkeypatch, how):
    rows = spark.range(200).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("k"), "id")
    table = spark.createDataFrame([("hot", "x" * 5000), ("3", "y"), ("9", "z" * 100)], "k string, v string")
    want = sorted(map(str, skew.lookup_join(rows, table, ["k"], how).collect()))
    monkeypatch.setattr(skew.fits, "__defaults__", (100,))
    assert not skew.fits(table, 10)
    assert sorted(map(str, skew.lookup_join(rows, table, ["k"], how, hot_rows=50).collect())) == want


def test_a_hot_user_and_minute_is_many_groups(spark, tmp_path):
    """A third of all edits are of one user in one minute."""
    base = 1_700_000_040
    rows = [(k, "hot" if k % 3 == 0 else f"u{k % 50}", base + (k % 60 if k % 3 == 0 else k), f"t{k}") for k in range(900)]
    rows += [(5000, "last", base + 9000, "t"), (5001, None, base, "t")]
    table = spark.createDataFrame(rows, "id long, user string, timestamp long, title string")
    path = str(tmp_path / "edits")
    table.repartition(3).write.parquet(path)
    stream = spark.readStream.schema(table.schema).parquet(path)
    enriched = services.enrich_activity_stream(stream)
    out = str(tmp_path / "out")
    finish(enriched.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start())
    got = spark.read.parquet(out)
    want = ch.enrich_activity(table).select(got.columns)
    assert got.exceptAll(want).count() == 0
    closed = want.filter((F.floor(F.col("timestamp") / 60) + 1) * 60 < base + 9000 - 60)
    assert closed.filter("user IS NOT NULL").exceptAll(got).count() == 0
    salts = table.filter("user = 'hot'").groupBy(F.pmod(F.xxhash64(*table.columns), F.lit(services.ACTIVITY_SALTS))).count().collect()
    assert len(salts) == services.ACTIVITY_SALTS and max(r["count"] for r in salts) < 2 * 300 / services.ACTIVITY_SALTS
