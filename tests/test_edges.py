"""Edge rows of each operator, on small hand-made tables."""

import json

import pytest
from pyspark.sql import functions as F

from editsieve.functions import hashing, text as ft, vectors as fv
from editsieve.operators import changes as ch, evaluation as ev, numbering, skew, texts as tx
from editsieve.sources import texts as src


def raw(**fields):
    return json.dumps(fields)


def test_raw_messages(spark):
    good = raw(meta={"domain": "x", "id": 1}, server_name="s", type="edit", length={"old": 1, "new": 2})
    rows = [
        good, "{broken", None, "", raw(server_name="s", type="edit"),
        raw(meta={"domain": "canary"}, server_name="s", type="edit"),
        raw(meta={"domain": "x"}, server_name="other", type="edit"),
        raw(meta={"domain": "x"}, server_name="s", type="log"),
        raw(meta={"domain": "x"}, type="edit"),
    ]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    assert [r.value for r in ch.clean_raw_changes(df, "s", "edit").collect()] == [good]
    assert ch.clean_raw_changes(df).count() == 4


def test_parse_envelope_drops_and_counts(spark):
    from pyspark.sql import Observation

    rows = [
        raw(meta={"domain": "x"}, id=1, user="a", bot=True, length={"old": 1}, timestamp=5),
        "not json", raw(id=2, user="b", bot="perhaps"), None,
    ]
    df = spark.createDataFrame(
        [(b"k", None if r is None else r.encode()) for r in rows], "key binary, value binary"
    )
    parsed = ch.parse_envelope(df, keep_key=True).collect()
    assert [(r.id, r.user, r.bot, r.meta, r.length, bytes(r.key)) for r in parsed] == [
        (1, "a", True, '{"domain":"x"}', '{"old":1}', b"k")
    ]
    assert ch.parse_envelope(df, observe="parse").count() == 1
    assert Observation  # the observation itself is checked on a stream


def test_text_and_label(spark):
    df = spark.createDataFrame(
        [("T", "c", True), ("T", None, False), (None, "c", None)],
        "title string, comment string, bot boolean",
    )
    rows = ch.label_from_flag(ch.with_text(df)).collect()
    assert [(r.text, r.label) for r in rows] == [("Tc", 1), ("TNULL", 0), (None, 0)]


def test_activity_keeps_rows(spark):
    df = spark.createDataFrame(
        [(1, 0, "a"), (2, 59, "a"), (3, 60, "a"), (4, 10, "b"), (5, 10, None)],
        "id bigint, timestamp bigint, user string",
    )
    want = {1: 2, 2: 2, 3: 1, 4: 1, 5: 0}
    for options in ({}, {"broadcast_rows": 0, "hot_rows": 1}, {"broadcast_rows": 0}):
        got = ch.enrich_activity(df, **options).collect()
        assert {r.id: r.edits_per_minute for r in got} == want and len(got) == 5


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_ways_agree(spark, how):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(["h"] * 20 + ["c", "d", None, None])], "k string, i int")
    table = spark.createDataFrame([("h", 1), ("c", 2), ("x", 3)], "k string, v int")
    plain = sorted(map(str, rows.join(table, ["k"], how).collect()))
    for options in ({}, {"broadcast_rows": 0, "hot_rows": 5}, {"broadcast_rows": 0, "hot_rows": 99}):
        joined = skew.lookup_join(rows, table, ["k"], how, **options)
        assert sorted(map(str, joined.collect())) == plain


def test_sampling(spark):
    df = spark.createDataFrame([(f"u{i}",) for i in range(2000)] + [(None,)], "user string")
    for hasher in hashing.HASHERS:
        kept = ch.hash_sample(df, "user", 0.2, hasher)
        assert 300 < kept.count() < 500 and kept.filter("user IS NULL").count() == 0
        assert ch.hash_sample(df, "user", 1.0, hasher).count() == 2000
        assert ch.hash_sample(df, "user", 0.0, hasher).count() == 0
    with pytest.raises(ValueError):
        ch.hash_sample(df, "user", 1.5)


@pytest.mark.parametrize("counts, empty, want", [
    ((0, 0, 0, 0), 1.0, (1.0, 1.0, 1.0, 1.0)),
    ((0, 0, 0, 0), 0.0, (1.0, 0.0, 0.0, 0.0)),
    ((3, 0, 0, 3), 1.0, (1.0, 1.0, 1.0, 1.0)),
    ((0, 2, 0, 4), 1.0, (0.5, 0.0, 1.0, 0.0)),
    ((0, 0, 2, 4), 1.0, (0.5, 1.0, 0.0, 0.0)),
    ((0, 1, 1, 4), 1.0, (0.5, 0.0, 0.0, 0.0)),
    ((1, 1, 1, 4), 0.0, (0.5, 0.5, 0.5, 0.5)),
])
def test_metric_guards(spark, counts, empty, want):
    df = spark.createDataFrame(
        [counts], "true_positives bigint, false_positives bigint, false_negatives bigint, "
        "total_observations bigint",
    )
    row = ev.derive_metrics(df, empty).first()
    assert (row.accuracy, row.precision, row.recall, row.f1_score) == want


def test_metrics_of_no_rows(spark):
    none = spark.createDataFrame([], "bot boolean, prediction int")
    row = ev.validation_report(none).first()
    assert (row.total_observations, row.accuracy, row.f1_score) == (0, 1.0, 0.0)


def test_precision_floor(spark):
    df = spark.createDataFrame([(0.94, 0.5), (0.95, 0.5)], "precision double, f1_score double")
    assert [r.score for r in ev.f1_with_precision_floor(df).collect()] == [0.5, 0.7]


def test_windows_agree_with_spark_windows(spark):
    df = spark.createDataFrame(
        [(i * 37 % 5000, i % 3 == 0, i % 2) for i in range(400)],
        "timestamp bigint, bot boolean, prediction int",
    )
    panes = ev.windowed_confusion(df).collect()
    direct = ev.confusion_flags(df).groupBy(
        F.window(ch.event_time(), "10 minutes", "5 minutes")
    ).agg(F.sum("tp").alias("tp"), F.count("*").alias("n")).collect()
    assert {(r.window_start, r.window_end, r.true_positives, r.total_observations) for r in panes} == {
        (r.window.start, r.window.end, r.tp, r.n) for r in direct
    }


@pytest.mark.parametrize("labels, mode, want", [
    ([1, 1, 0], None, {0: 1.0, 1: 1.0}),
    ([1, 0], "balanced", {0: 1.0, 1: 1.0}),
    ([1] + [0] * 99, "balanced", {0: 100 / 198, 1: 50.0}),
    ([1] + [0] * 99, "sqrt", {0: (100 / 198) ** 0.5, 1: 50.0 ** 0.5}),
    ([1, 1], "balanced", {1: 1.0}),
])
def test_class_weights(spark, labels, mode, want):
    df = spark.createDataFrame([(x,) for x in labels], "label int")
    got = {r.label: r.weight for r in ev.class_weights(df, mode).collect()}
    assert got == pytest.approx(want)


def test_class_weight_mode_is_checked(spark):
    with pytest.raises(ValueError):
        ev.class_weight_table(spark.createDataFrame([(1,)], "label int"), "other")


def test_dense_ids_and_running_sums(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("key"), F.lit(2).alias("two"))
    for partitions in (1, 3, 16):
        rows = numbering.dense_id(df, ["key"], "n", start=5, partitions=partitions).collect()
        assert all(r.n == r.key + 5 for r in rows) and len(rows) == 1000
        sums = numbering.running_sum(df, "two", ["key"], "total", partitions).collect()
        assert all(r.total == 2 * (r.key + 1) for r in sums) and len(sums) == 1000


@pytest.mark.parametrize("n, train", [(1, 1), (10, 10), (20, 19), (101, 91)])
def test_split_is_disjoint_and_complete(spark, n, train):
    first, rest = numbering.ordered_split(spark.range(n), ["id"])
    assert first.count() == train and rest.count() == n - train
    assert {r.id for r in first.collect()} | {r.id for r in rest.collect()} == set(range(n))


def test_tokens(spark):
    df = spark.createDataFrame(
        [(1, "The Cat, the  HAT"), (2, "!!! 123"), (3, "Київ й МІСТО"), (4, "the THE")],
        "id bigint, text string",
    )
    stop = spark.createDataFrame([("the",), ("й",)], "word string")
    stems = spark.createDataFrame([("cat", "ca"), ("місто", "міст")], "token string, stem string")
    rows = tx.clean_tokens(df, "text", "tokens", stop, stems).collect()
    assert {r.id: r.tokens for r in rows} == {1: ["ca", "hat"], 3: ["київ", "міст"]}


def test_long_stopword_list_by_join(spark, monkeypatch):
    monkeypatch.setattr(tx, "INLINE_WORDS", 1)
    df = spark.createDataFrame([(1, ["a", "b", "a", "c"]), (2, ["a"]), (3, [])], "id bigint, t array<string>")
    stop = spark.createDataFrame([("a",), ("z",)], "word string")
    assert {r.id: r.t for r in tx.remove_noise(df, "t", stop).collect()} == {1: ["b", "c"], 2: [], 3: []}


def test_whitespace_tokens_keep_case(spark):
    row = spark.range(1).select(ft.whitespace_tokens(F.lit("  A-b  c\tD\n")).alias("t")).first()
    assert row.t == ["A-b", "c", "D"]


def test_vector_cases(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-1.0, 0.0]), (None, [1.0, 0.0])],
        "a array<double>, b array<double>",
    )
    rows = df.select(
        fv.cosine_distance(F.col("a"), F.col("b")).alias("c"),
        fv.euclidean_distance(F.col("a"), F.col("b")).alias("e"),
    ).collect()
    assert [r.c for r in rows] == [0.0, 0.0, 2.0, 2.0]
    assert [r.e for r in rows] == [0.0, 1.0, 2.0, None]


def test_mean_vector(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 6.0]],), ([],)], "v array<array<double>>")
    assert [r.m for r in df.select(fv.mean_vector(F.col("v"), 2).alias("m")).collect()] == [[2.0, 4.0], None]


def test_iou_cases(spark):
    df = spark.createDataFrame(
        [(None, [1]), ([1], None), ([1, 2], [2, 1]), ([1], [2]), ([1, 2, 3], [2, 3, 4]), (None, None)],
        "r array<bigint>, p array<bigint>",
    )
    got = [r.i for r in df.select(fv.iou(F.col("r"), F.col("p")).alias("i")).collect()]
    assert got == [1.0, 0.0, 1.0, 0.0, 0.5, 1.0]


def test_listings(spark):
    df = spark.createDataFrame(
        [(9, "b"), (3, "a"), (5, "b"), (7, None), (None, "c"), (4, "a")], "id bigint, name string"
    )
    assert [(r.id, r.name) for r in src.clean_listings(df).orderBy("id").collect()] == [(0, "a"), (1, "b")]
    assert src.clean_listings(df.filter("id IS NOT NULL"), 2).count() == 1
    assert src.first_rows(df, 0).count() == 6


@pytest.mark.parametrize("inline", [1, 20_000])
def test_tokens_of_null_and_repeated_ids_stay_with_their_rows(spark, monkeypatch, inline):
    monkeypatch.setattr(tx, "INLINE_WORDS", inline)
    lists = [(1, ["a", "b"]), (1, ["c", "the", "c"]), (None, ["d", "of"]), (None, ["the"]), (2, None), (2, [])]
    df = spark.createDataFrame(lists, "id long, t array<string>")
    stop = spark.createDataFrame([("the",), ("of",), (None,), ("of",)], "word string")
    got = sorted(((r.id, r.t) for r in tx.remove_noise(df, "t", stop).collect()), key=str)
    assert got == sorted([(1, ["a", "b"]), (1, ["c", "c"]), (None, ["d"]), (None, []), (2, None), (2, [])], key=str)
    stems = spark.createDataFrame([("c", "k"), ("d", "e")], "token string, stem string")
    got = sorted(((r.id, r.t) for r in tx.stem_tokens(df, "t", stems).collect()), key=str)
    want = [(1, ["a", "b"]), (1, ["k", "the", "k"]), (None, ["e", "of"]), (None, ["the"]), (2, None), (2, [])]
    assert got == sorted(want, key=str)
    rows = spark.createDataFrame([(1, "a b"), (1, "c the"), (None, "of d"), (None, "the")], "id long, text string")
    got = sorted(((r.id, r.tokens) for r in tx.clean_tokens(rows, "text", "tokens", stop, stems).collect()), key=str)
    assert got == sorted([(1, ["a", "b"]), (1, ["k"]), (None, ["e"])], key=str)


def test_letter_tokens_are_runs_of_letters(spark):
    texts = ["  a1B--C ", "\u0130\u212a", "12 !", "", "Ѐ,ӿ", None]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id bigint, text string")
    got = {r.id: r.t for r in rows.select("id", ft.letter_tokens(F.col("text")).alias("t")).collect()}
    assert got == {0: ["a", "b", "c"], 1: [""], 2: [""], 3: [""], 4: ["ѐ", "ӿ"], 5: None}


def test_texts_are_cleaned_once_for_their_weights(spark):
    seen = spark.sparkContext.accumulator(0)

    def tokens(text):
        seen.add(1)
        return text.split()

    split = F.udf(tokens, "array<string>")
    rows = spark.createDataFrame([(1, "a b"), (2, "b c")], "id bigint, text string")
    got = tx.tfidf_features(rows.select("id", split("text").alias("tokens"))).select("id", "features").collect()
    assert len(got) == 2 and seen.value == 2


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_a_table_beyond_the_bound_is_not_broadcast(spark, how):
    rows = spark.createDataFrame([(k % 9,) for k in range(30)], "k bigint")
    table = spark.createDataFrame([(k, k * k) for k in range(5)], "k bigint, v bigint")
    joined = skew.lookup_join(rows, table, ["k"], how, broadcast_rows=2)
    assert "Broadcast" not in joined._jdf.queryExecution().sparkPlan().toString()
    assert joined.count() == rows.join(table, "k", how).count()
