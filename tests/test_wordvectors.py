"""Word vectors in parts: a vocabulary beyond what the driver may hold, means by bundles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from editsieve.operators import classifier as cl, texts as tx, wordvectors as wv


@pytest.fixture
def in_parts(monkeypatch):
    monkeypatch.setattr(tx, "DRIVER_WORDS", 10)
    monkeypatch.setattr(wv, "PART_TOKENS", 4000)
    monkeypatch.setattr(wv, "BUNDLE_TOKENS", 500)
    monkeypatch.setattr(cl, "fits", lambda *a: False)


def texts(spark, n=1500):
    random = np.random.default_rng(5)
    rows = []
    for k in range(n):  # two topics of words that come together
        rows.append((k, [f"{'ab'[k % 2]}{w}" for w in random.integers(0, 20, 12)]))
    return spark.createDataFrame(rows, "id long, tokens array<string>").repartition(6)


def test_words_of_one_topic_are_near(spark, in_parts, monkeypatch):
    monkeypatch.setattr(wv, "PART_TOKENS", 40_000)
    model = tx.fit_word2vec(texts(spark, 8000), size=16)
    assert isinstance(model, wv.SpreadWord2VecModel)
    found = {r["word"]: r["vector"].toArray() for r in model.getVectors().collect()}
    assert len(found) == 40
    unit = {w: v / np.linalg.norm(v) for w, v in found.items()}
    of = lambda x, y: np.mean([unit[p] @ unit[q] for p in unit for q in unit if p[0] == x and q[0] == y and p != q])
    assert of("a", "a") > of("a", "b") + 0.3 and of("b", "b") > of("a", "b") + 0.3


def test_means_by_bundles_are_those_by_broadcast(spark, monkeypatch):
    odd = [(1, None), (2, []), (3, ["x", None, "y", "x"]), (3, ["y"]), (4, ["unknown"]), (None, ["x"])]
    rows = texts(spark, 300).unionByName(spark.createDataFrame(odd, "id long, tokens array<string>"))
    known = [(w, [float(k), 1.0 / (k + 1)]) for k, w in enumerate(["x", "y", *[f"a{n}" for n in range(20)]])]
    vectors = spark.createDataFrame(known, "token string, vector array<double>")
    near = lambda df: {r["id"]: np.array(r["embedding"]).round(9).tolist() for r in df.collect()}
    want = near(cl.embed_tokens(rows, "id", "tokens", vectors))
    monkeypatch.setattr(cl, "fits", lambda *a: False)
    monkeypatch.setattr(wv, "BUNDLE_TOKENS", 200)
    monkeypatch.setattr(wv, "_GATHERED", 30)
    assert near(cl.embed_tokens(rows, "id", "tokens", vectors)) == want and len(want) > 300


def test_model_of_parts_gives_every_row_its_mean(spark, in_parts):
    rows = texts(spark, 200).unionByName(spark.createDataFrame([(900, []), (900, ["a1", "a1"])], "id long, tokens array<string>"))
    model = tx.fit_word2vec(rows, size=8)
    found = model.transform(rows).filter("id = 900").collect()
    one = model.getVectors().filter(F.col("word") == "a1").first()["vector"].toArray()
    assert sorted(np.allclose(r["features"].toArray(), one) for r in found) == [False, True]
    assert any(not r["features"].toArray().any() for r in found) and model.transform(rows).count() == 202


def test_many_stems_are_sent_to_bundles(spark, monkeypatch):
    lists = [(1, ["a", "b", None]), (None, ["c", "x", "c"]), (None, ["d"]), (2, None), (2, []), (3, ["a"] * 700)]
    df = spark.createDataFrame(lists, "id long, t array<string>").withColumn("more", F.lit("kept"))
    stems = spark.createDataFrame([("a", "A"), ("c", "k"), (None, "n"), ("b", None)], "token string, stem string")
    rows = lambda: sorted(((r.id, r.t, r.more) for r in tx.stem_tokens(df, "t", stems).collect()), key=str)
    want = [(1, ["A", "b"]), (None, ["k", "x", "k"]), (None, ["d"]), (2, None), (2, []), (3, ["A"] * 700)]
    want = sorted(((*row, "kept") for row in want), key=str)
    assert rows() == want
    monkeypatch.setattr(tx, "fits", lambda *a: False)
    monkeypatch.setattr(tx, "BUNDLE_TOKENS", 300)
    assert rows() == want


def test_rows_do_not_move_for_features_or_few_stems(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"]), (2, [])], "id long, tokens array<string>")
    stems = spark.createDataFrame([("a", "A")], "token string, stem string")
    plan = tx.stem_tokens(df, "tokens", stems)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
    made = tx.tfidf_md5_features(df, columns=["id"])
    assert made.columns == ["id", "features"] and "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, sum(x > 0 for x in r.features)) for r in made.collect()) == [(1, 2), (2, 0), (2, 1)]


def test_a_written_table_is_not_written_again(spark):
    from editsieve import session

    once = session.cut_lineage(spark.range(3))
    assert session.cut_lineage(once) is once and not session.is_written(once.select("id"))


def test_vectors_of_double_precision_stay_whole_in_bundles(spark, monkeypatch):
    monkeypatch.setattr(cl, "fits", lambda *a: False)
    rows = spark.createDataFrame([(1, ["x", "y"])], "id long, tokens array<string>")
    for one in (0.1, 0.5):  # the second is the same in single precision
        vectors = spark.createDataFrame([("x", [one]), ("y", [one * 2])], "token string, vector array<double>")
        assert cl.embed_tokens(rows, "id", "tokens", vectors).first()["embedding"] == [(one + one * 2) / 2]
