"""Round trips: quoting, merging, replay, articles, stopwords, models."""

import json

import pytest
from pyspark.sql import functions as F

from editsieve.operators import classifier as cl, texts as tx
from editsieve.schemas import CHANGE_SCHEMA, LISTING_SCHEMA
from editsieve.session import query_checkpoint
from editsieve.sources import recorded, texts as src, topics, versions

AWKWARD = ['plain', 'with, comma', 'line\nbreak', 'say "hi"', '"', '', None, 'back\\slash', "Київ\r\nx", ' padded ']


def test_quoting(spark, tmp_path):
    rows = spark.createDataFrame(list(enumerate(AWKWARD)), "id bigint, name string")
    recorded.write_csv(rows.coalesce(1), str(tmp_path / "csv"))
    for schema in (LISTING_SCHEMA, None):
        back = recorded.scan_quoted_csv(spark, str(tmp_path / "csv"), schema)
        want = [None if name == "" else name for name in AWKWARD]  # empty reads as null
        assert [r.name for r in back.orderBy("id").collect()] == want


def test_changes_csv(spark, tmp_path):
    values = {"id": 7, "timestamp": 5, "user": "u", "bot": True, "minor": None, "namespace": 0,
              "comment": 'a "b"\nc', "title": " t ", "meta": '{"domain":"x"}'}
    row = tuple(values.get(f.name) for f in CHANGE_SCHEMA.fields)
    recorded.write_csv(spark.createDataFrame([row], CHANGE_SCHEMA), str(tmp_path / "c"))
    back = recorded.scan_changes_csv(spark, str(tmp_path / "c"))
    assert back.schema == CHANGE_SCHEMA and tuple(back.first()) == row


def test_merge_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text("name,extra,id\nz,e,2\n")
    (tmp_path / "c.txt").write_text("id,name\n9,no\n")
    merged = recorded.merge_folder(spark, str(tmp_path), str(tmp_path / "out"), {"id": "bigint"}, one_file=True)
    assert sorted((r.id, r.name, r.extra) for r in merged.collect()) == [(1, "x\ny", None), (2, "z", "e")]
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(ValueError):
        recorded.merge_folder(spark, str(empty))


def test_replay_order_and_gaps(spark, tmp_path):
    df = spark.range(2000).select(
        "id", ((F.col("id") * 7) % 500).alias("timestamp"), F.lit("u").alias("user")
    )
    rows = recorded.replay_changes(df, scale_ms=10.0, partitions=5).orderBy("arrival_us").collect()
    assert [(r.timestamp, r.id) for r in rows] == sorted((r.timestamp, r.id) for r in rows)
    assert rows[0].arrival_us == 0 and 8000 < rows[-1].arrival_us / 2000 < 12000
    assert json.loads(rows[0].value) == {"id": rows[0].id, "timestamp": rows[0].timestamp, "user": "u"}
    recorded.write_replay_files(recorded.replay_changes(df), str(tmp_path / "replay"), 4)
    files = sorted((tmp_path / "replay").glob("part-*.parquet"))
    ends = [spark.read.parquet(str(f)).agg(F.min("timestamp"), F.max("timestamp")).first() for f in files]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:])) and len(files) == 4


def test_articles_and_stopwords(spark, tmp_path):
    body = {"items": [{"articles": [{"article": "A", "views": 3, "rank": 1}, {"article": "B", "rank": 2}]}]}
    (tmp_path / "top.json").write_text(json.dumps(body, indent=1))
    rows = src.load_articles(spark, str(tmp_path / "top.json")).orderBy("rank").collect()
    assert [(r.article, r.rank) for r in rows] == [("A", 1), ("B", 2)]
    (tmp_path / "en.txt").write_text("the\nand\n\n")
    (tmp_path / "uk.txt").write_text("та\nthe \n")
    words = src.load_stopwords(spark, [str(tmp_path / "en.txt"), str(tmp_path / "uk.txt")])
    assert sorted(r.word for r in words.collect()) == ["and", "the", "та"]


def test_listings_file(spark, tmp_path):
    (tmp_path / "l.csv").write_text('id,name,extra\n5,"Flat ""A"", sea\nview",x\n2,Loft,y\n9,Loft,z\n')
    rows = src.load_listings(spark, str(tmp_path / "l.csv")).orderBy("id").collect()
    assert [(r.id, r.name) for r in rows] == [(0, "Loft"), (1, 'Flat "A", sea\nview')]


def test_topic_rows_are_checked(spark):
    with pytest.raises(ValueError):
        topics.write_topic(spark.range(1), "b", "t", "/tmp", "n")


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    assert versions.newest_version(spark, path) is None
    assert versions.read_version(spark, path, "id bigint", None).count() == 0
    for version in (0, 1, 1):
        versions.publish(spark.range(version + 3), path, version)
    assert versions.newest_version(spark, path) == 1 and versions.newest_version(spark, path, 1) == 0
    assert versions.read_version(spark, path, "id bigint", 1).count() == 4


def test_checkpoint_folder_per_query():
    assert query_checkpoint("/root/", "a") != query_checkpoint("/root/", "b")


def labelled(spark, n=60):
    texts = [("Buy cheap pills now", 1), ("revert vandalism on page", 0), ("Buy pills cheap", 1), ("fix typo page", 0)]
    rows = [(i, *texts[i % 4]) for i in range(n)] + [(n, "   ", 0)]
    return spark.createDataFrame(rows, "id bigint, text string, label int").withColumn("bot", F.col("label") == 1)


def vectors(spark):
    words = {"Buy": 1.0, "cheap": 0.9, "pills": 0.8, "now": 0.1, "revert": -1.0, "page": -0.7, "fix": -0.9}
    return spark.createDataFrame([(w, [x, x * x]) for w, x in words.items()], "token string, vector array<double>")


def test_classifier_round_trip(spark, tmp_path):
    rows = labelled(spark)
    model = cl.fit_classifier(rows, vectors(spark), cl.ClassifierParams(weight_type="sqrt"))
    predicted = {r.id: (r.prediction, r.label) for r in model.predict(rows).collect()}
    assert all(p == label for p, label in predicted.values()) and len(predicted) == 61
    path = str(tmp_path / "model")
    cl.save_classifier(model, path)
    with pytest.raises(ValueError):
        cl.save_classifier(model, path)
    again = cl.load_classifier(spark, path)
    assert {r.id: (r.prediction, r.label) for r in again.predict(rows).collect()} == predicted
    by_text = again.predict_texts(rows.drop("id"))
    assert by_text.count() == 61 and by_text.filter("prediction <> label").count() == 0
    # the model as numbers gives the same answer
    weights, intercept = model.model.coefficients.toArray().tolist(), model.model.intercept
    embedded = cl.embed_texts(rows, "text", vectors(spark)).filter("embedding IS NOT NULL")
    _, flag = cl.linear_prediction(F.col("embedding"), weights, intercept)
    assert {r.id: r.p for r in embedded.select("id", flag.alias("p")).collect()} == {
        i: p for i, (p, _) in predicted.items() if i != 60
    }


def test_empty_text_has_no_embedding_and_is_predicted_clean(spark):
    rows = labelled(spark)
    assert cl.embed_texts(rows, "text", vectors(spark)).filter("id = 60").first().embedding is None


def test_first_best_set_wins(spark):
    rows = labelled(spark)
    grid = [cl.ClassifierParams(5, 0.1), cl.ClassifierParams(10, 0.1)]
    scores, model = cl.search_classifier(rows, rows, vectors(spark), grid)
    assert [r.score for r in scores.collect()] == [1.2, 1.2] and model.params == grid[0]
    with pytest.raises(ValueError):
        cl.ClassifierParams(weight_type="other")
    assert len(cl.default_grid()) == 24


def test_word2vec_is_repeatable(spark):
    rows = spark.createDataFrame([(i, f"red flat {i % 3} near sea") for i in range(30)], "id bigint, name string")
    twice = [tx.add_features(rows, "name", seed=3).orderBy("id").select("features").collect() for _ in range(2)]
    assert twice[0] == twice[1] and len(twice[0][0].features) == 64
    sparse = tx.add_features(rows, "name", method="tfidf").first().features
    assert sparse.size == 64
    with pytest.raises(ValueError):
        tx.add_features(rows, "name", method="other")
