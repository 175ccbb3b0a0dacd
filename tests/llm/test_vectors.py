"""Exact top-k and approximate neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from editsieve.llm import forest, topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def asked():
    return F.col("vec_id") % 50 == 0


def table(spark, vectors, extra=()):
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(vectors)]
    return spark.createDataFrame([*rows, *extra], SCHEMA).repartition(3)


def vectors(count=700, size=16):
    random = np.random.default_rng(2)
    out = random.standard_normal((count, size)).astype(np.float32)
    out[100:180] = out[min(100, count - 1)]  # ties
    out[300:301] = 0
    return out


def odd_rows(size=16):
    return [
        (2000, None, 0), (None, [1.0] * size, 0), (2050, [float("nan")] * size, 0), (2100, [float("inf")] * size, 0),
        (2150, [None] * size, 0), (2200, [], 0), (2250, [1.0] * (size + 1), 0),
    ]


@pytest.mark.parametrize("levels,few", [(8, 0.2), (3, 0.0), (64, 1.0)])
def test_top_k_is_exact(spark, monkeypatch, levels, few):
    monkeypatch.setattr(topk, "LEVELS", levels)
    monkeypatch.setattr(topk, "FEW", few)
    held = vectors()
    exact = np.floor(held.astype(float) * 256).astype(np.int64)
    got = {}
    for r in topk.top_k(table(spark, held, odd_rows()), asked()).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 700, 50))
    for q, found in got.items():
        score = exact @ exact[q]
        order = [k for k in np.lexsort((np.arange(len(score)), -score)) if k != q][:5]
        assert sorted(found) == [(n, k, score[k]) for n, k in enumerate(order, 1)]


def test_small_and_empty_tables(spark):
    held = table(spark, vectors(3))
    for found in (topk.top_k(held, asked()), forest.neighbours(held, asked())):
        assert sorted((r["query_id"], r["rank"]) for r in found.collect()) == [(0, 1), (0, 2)]
    none = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(none, asked()).collect() == [] and forest.neighbours(none, asked()).collect() == []
    twice = table(spark, vectors(3)).union(table(spark, vectors(3))).withColumn("block", F.lit("clash"))
    assert topk.top_k(twice, asked()).count() == 2


def truth(held, q, k=5):
    held = held.astype(float)
    norms = np.linalg.norm(held, axis=1)
    with np.errstate(invalid="ignore"):
        score = (held @ held[q]) / (norms * norms[q])
    score[norms == 0] = -9
    score[q] = -9
    return score, sorted(range(len(score)), key=lambda n: (-round(score[n], 12), n))[:k]


def test_neighbours_are_exact_if_all_is_searched_and_near_otherwise(spark):
    held = vectors()
    rows = table(spark, held, odd_rows())
    whole = {}
    for r in forest.neighbours(rows, asked(), searched=1.0).collect():
        whole.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(whole) == set(range(0, 700, 50)) - {300}
    for q, found in whole.items():
        score, order = truth(held, q)
        assert [k for _, k, _ in sorted(found)] == order
        assert [s for _, _, s in sorted(found)] == pytest.approx([score[k] for k in order], abs=1e-12)
    hits = total = 0
    for r in forest.neighbours(rows, asked()).collect():
        score, order = truth(held, r["query_id"])
        assert r["score"] == pytest.approx(score[r["vec_id"]], abs=1e-12)
        hits, total = hits + (score[r["vec_id"]] >= score[order[-1]] - 1e-12), total + 1
    assert hits / total >= 0.9


def test_recall_on_the_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    held = {r["vec_id"]: r["embedding"] for r in rows.collect()}
    names = sorted(held)
    matrix = np.array([held[k] for k in names], np.float32)
    hits = total = 0
    for r in forest.neighbours(rows, asked()).collect():
        score, order = truth(matrix, names.index(r["query_id"]))
        hits, total = hits + (score[names.index(r["vec_id"])] >= score[order[-1]] - 1e-12), total + 1
    assert total == 50 and hits / total >= 0.9
