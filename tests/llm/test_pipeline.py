"""The pipeline stage by stage, each against a plain version of its decision on its own input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from editsieve.llm import quality, toxicity
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SF).write.parquet(f"{folder}/{number}")
        tables.append(spark.read.parquet(f"{folder}/{number}"))
    return tables


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_all_but_the_last_keep_the_columns(stages):
    assert all(t.columns == stages[0].columns for t in stages[:-1])
    counts = [t.count() for t in stages[:4]]
    assert counts == sorted(counts, reverse=True) and counts[3] > 0.5 * counts[0]


def test_rejected_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model, prior = quality.fit_form(stages[0], labels)
    good = {r["doc_id"] for r in quality.score(stages[0], model, prior).collect() if r["is_good"]}
    assert {k for k, _ in pairs(stages[1])} == good
    chain = toxicity.fit_chain(stages[1], toxicity.of_labels(labels), toxicity.CATEGORIES)
    civil = {r["doc_id"] for r in toxicity.predict(stages[1], chain).collect() if not r["is_toxic"]}
    assert {k for k, _ in pairs(stages[2])} == civil


def test_one_of_each_class_stays(stages):
    classes = brute.components(pairs(stages[2]))
    assert {k for k, _ in pairs(stages[3])} == {least for _, least in classes.values()}


def test_near_duplicates_go_by_row(spark):
    """Null, repeated and clashing ids: of each class one row stays, and no class is lost."""
    a, b = " ".join(f"alpha{k}" for k in range(30)), " ".join(f"beta{k}" for k in range(30))
    near_b = b + " beta30"
    rows = [(1, a), (5, a), (5, b), (9, near_b), (9, near_b), (None, a), (None, "only null"), (None, "only null"), (7, None), (7, None), (8, "  "), (3, "x"), (3, "x")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("chunk", F.lit("clash")).withColumn("component", F.lit("clash")).repartition(3)
    got = corpus_pipeline.keep_first_of_class(spark, docs, "")
    assert got.columns == docs.columns
    want = Counter([(1, a), (5, b), (None, "only null"), (7, None), (7, None), (8, "  "), (3, "x")])
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == want
    assert corpus_pipeline.keep_first_of_class(spark, docs.limit(0), "").collect() == []


def test_repeated_passages_go(stages):
    before = pairs(stages[3])
    after = {r["doc_id"]: r for r in stages[4].collect()}
    for number, w, gone in brute.kept_words(before):
        text = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (after[number]["text"], after[number]["n_chars"]) == (text, len(text))


def test_all_documents_are_packed(stages):
    assert {r["doc_id"] for r in stages[5].select("doc_id").collect()} == {k for k, _ in pairs(stages[4])}


def test_run_is_the_stages_in_order(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.select("doc_id", "start", "ids_crc32").collect())) == sorted(
        map(tuple, stages[5].select("doc_id", "start", "ids_crc32").collect())
    )


def test_queries_are_registered():
    names = entry.queries()
    for number in range(1, 14):
        assert len([n for n in names if n.startswith(f"op{number}_")]) == 1
    assert "pipeline" in names
