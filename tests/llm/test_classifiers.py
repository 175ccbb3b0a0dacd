"""Quality and toxicity: held-out accuracy on the given labels, shrinkage, chains, and the awkward cases."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from editsieve.llm import linear, quality, toxicity
from tests.llm.data import DOCS, corpus, documents

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    test = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    return docs, labels.filter(~test), labels.filter(test)


def test_quality_of_held_out_labels(given):
    docs, train, test = given
    model, prior = quality.fit_form(docs, train)
    got = quality.score(docs, model, prior)
    assert got.count() == docs.count()
    rows = got.join(test, "doc_id").select("is_good", "quality").collect()
    assert np.mean([r["is_good"] == (r["quality"] == 1) for r in rows]) >= 0.95


def test_toxicity_of_held_out_labels(spark):
    """On the labels of sf0.1: a few hundred labels, as at sf0.01, do not show most of the rare words."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    train, test = labels.filter(~held_out), labels.filter(held_out)
    chain = toxicity.fit_chain(docs, toxicity.of_labels(train), toxicity.CATEGORIES)
    rows = toxicity.predict(docs, chain).join(test, "doc_id").select("is_toxic", "toxic").collect()
    assert np.mean([r["is_toxic"] == (r["toxic"] == 1) for r in rows]) >= 0.93
    assert len(chain.models[1][0]) == len(chain.features) + 1  # the second model sees the first category


def test_sparse_sites_are_shrunk_more(spark):
    sites = spark.createDataFrame([("a", 1000.0, 900.0, 850.0), ("b", 2.0, 0.0, 0.0), ("c", 500.0, 100.0, 60.0)], "_host string, n double, p double, pp double")
    got = {r["_host"]: r["rate"] for r in quality._shrink(sites.withColumn("overall", F.lit(0.66)), ["_host"], "overall").collect()}
    assert abs(got["a"] - 0.9) < 0.01 and abs(got["c"] - 0.2) < 0.01
    assert 0.1 < got["b"] < 0.66


def test_the_site_moves_a_doubtful_document(spark):
    """Of two equal texts the one on a poor host has the lower score."""
    fine, poor = "Plain words in a row, nothing more.", "&&& %%% &&& %%% word &&& %%%"
    rows = [(k, fine if k < 40 else poor, "en", "good" if k < 40 else "bad", 0) for k in range(80)]
    rows += [(100, "a b", "en", "good", 0), (101, "a b", "en", "bad", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(k, int(k < 40), 0) for k in range(80)], "doc_id long, quality int, toxic int")
    model, prior = quality.fit_form(docs, labels)
    got = {r["doc_id"]: r["quality_score"] for r in quality.score(docs, model, prior).collect()}
    assert got[100] > got[101] and got[0] > 0.5 > got[79]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, None, None), (2, 1, 0), (2, 0, 1)]])
def test_classifiers_without_usable_labels(spark, labels):
    rows = [*corpus(), (None, "x y"), (1, None)]
    docs = documents(spark, rows).withColumns({"_rate": F.lit(1), "p_toxic": F.lit("clash"), "is_good": F.lit(1)})
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    model, prior = quality.fit_form(docs, table)
    scored = quality.score(docs, model, prior).collect()
    assert len(scored) == len(rows) and all(r["is_good"] for r in scored)
    chain = toxicity.fit_chain(docs, toxicity.of_labels(table), toxicity.CATEGORIES)
    got = toxicity.predict(docs, chain).collect()
    assert len(got) == len(rows) and all(0 <= r["p_toxic"] <= 1 for r in got)
    none = spark.createDataFrame([], DOCS)
    assert quality.score(none, model, prior).collect() == [] and toxicity.predict(none, chain).collect() == []


def test_measures_of_odd_texts_are_finite():
    values = quality.form(pa.array([None, "", " ", "a", "é" * 100, "A!" * 50, "x " * 1000]))
    assert np.isfinite(values).all()


def test_regression_finds_the_weights():
    random = np.random.default_rng(4)
    dense = random.standard_normal((4000, 3))
    y = (random.random(4000) < linear.sigmoid(dense @ np.array([2.0, -1.0, 0.0]) + 0.5)).astype(float)
    none = linear.Sparse(np.zeros(0, int), np.zeros(0, int), np.zeros(0), 4000, 0)
    weights, intercept = linear.fit(none.beside(dense), y, 0.01)
    assert np.allclose([*weights, intercept], [2, -1, 0, 0.5], atol=0.2)


def test_sample_is_one_row_for_each_labelled_id(spark):
    rows = [(1, "same text"), (1, "other text"), *[(2, f"copy {k % 3}") for k in range(3000)], (3, None), (4, "four"), (None, "null")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame(
        [(1, 1, None), (2, 0, 1), (2, 0, 1), (3, None, 0), (4, 0, 1), (4, 1, 1), (5, 1, 1), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int"
    )
    got = linear.labelled(docs, labels, ["quality", "toxic"], "doc_id", "text", 100).collect()
    assert len(got) == 4 and {(r["doc_id"], r["quality"], r["toxic"]) for r in got} == {(1, 1, None), (2, 0, 1), (3, None, 0), (4, None, 1)}
    assert linear.labelled(docs, labels, ["quality", "toxic"], "doc_id", "text", 2).count() <= 2
    again = linear.labelled(docs.repartition(3), labels, ["quality", "toxic"], "doc_id", "text", 100).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_a_missing_label_of_one_category_keeps_the_other(spark):
    docs = spark.createDataFrame([(k, ("vile awful " if k % 2 else "kind nice ") * 5) for k in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2 if k < 40 else None, k % 2 if k >= 30 else None) for k in range(80)], "doc_id long, poor int, toxic int")
    chain = toxicity.fit_chain(docs, labels, ["poor", "toxic"])
    got = toxicity.predict(docs, chain).collect()
    assert all(r["is_poor"] == r["is_toxic"] == (r["doc_id"] % 2 == 1) for r in got)
