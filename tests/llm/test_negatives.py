"""Hard negatives and the R-tree behind them against brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from editsieve.llm import negatives
from editsieve.llm.rtree import Search, Tree, tile_recursively

SCHEMA = "vec_id long, embedding array<float>, label int"
def anchor():
    return F.col("vec_id") % 10 == 0


def rows_of(count=240, size=6, seed=4):
    random = np.random.default_rng(seed)
    vectors = random.standard_normal((count, size)).astype(np.float32)
    vectors[60:140] = vectors[60]  # a hot vector, and its ties
    vectors[200] = 0
    labels = random.integers(0, 4, count)
    rows = [(int(k) if k < 220 else 7 * 10, [float(x) for x in v], int(y)) for k, (v, y) in enumerate(zip(vectors, labels, strict=True))]
    odd = [
        (300, None, 1), (None, [1.0] * size, 1), (310, [float("nan")] * size, 1), (320, [float("-inf")] * size, 1), (330, [None] * size, 1),
        (340, [], 1), (350, [1.0] * (size + 1), 1), (351, [0.9] * (size + 1), 1), (352, [0.8] * (size + 1), 2), (360, [1.0] * size, None),
    ]
    return [*rows, *odd, *rows[:15], *rows[55:65]]


def expected(rows, positives=5, count=3):
    held = [
        (i, np.floor(np.array(v, np.float64) * 256).astype(np.int64), y) for i, v, y in rows
        if i is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = Counter()
    for at, (i, v, y) in enumerate(held):
        if i % 10:
            continue
        scored = sorted((-int(v @ w), j, z) for k, (j, w, z) in enumerate(held) if k != at and len(w) == len(v))
        for s, j, _ in [x for x in scored if x[2] == y][:positives]:
            fit = [(n, k) for n, k, z in scored if z != y and 50 * -s <= 100 * -n <= 95 * -s][:count]
            out.update((i, j, r, k, -s, -n) for r, (n, k) in enumerate(fit, 1))
    return out


@pytest.mark.parametrize("block_rows", [8192, 24])
def test_same_as_brute_force(spark, block_rows, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 16 if block_rows == 24 else negatives.ANCHORS)
    rows = rows_of()
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("vec", "dim", "tile", "block", "row", "score", "place", "window"):
        table = table.withColumn(name, F.lit("clash"))
    got = negatives.mine(table, anchor(), block_rows=block_rows)
    assert Counter(tuple(r) for r in got.collect()) == expected(rows)


def test_small_and_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(none, anchor()).collect() == []
    alone = spark.createDataFrame([(0, [1.0, 0.0], 1)], SCHEMA)
    assert negatives.mine(alone, anchor()).collect() == []
    few = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.95], 2), (3, [0.96], 2), (4, [0.5], 3), (5, [0.4], 3)]
    got = negatives.mine(spark.createDataFrame(few, SCHEMA), anchor()).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 1, 2, 256 * 256, 256 * 243), (0, 1, 2, 4, 256 * 256, 256 * 128)]


def test_pages_and_boxes():
    random = np.random.default_rng(1)
    vectors = random.integers(-50, 50, (777, 5))
    order = tile_recursively(vectors, 16)
    assert sorted(order) == list(range(777))
    tree = Tree.of(np.arange(777), random.integers(0, 3, 777), vectors, 16, 4)
    for node in range(tree.leaves):
        page = tree.vectors[tree.begin[node] : tree.end[node]]
        assert (page.min(axis=0) == tree.low[node]).all() and (page.max(axis=0) == tree.high[node]).all() and 0 < len(page) <= 16
    assert (tree.low[-1] == vectors.min(axis=0)).all() and (tree.high[-1] == vectors.max(axis=0)).all()


def test_search_prunes_and_is_exact(monkeypatch):
    random = np.random.default_rng(2)
    vectors = random.integers(-9, 9, (2000, 2))  # few values: many ties
    labels = random.integers(0, 3, 2000)
    tree = Tree.of(np.arange(2000), labels, vectors, 16, 4)
    queries = vectors[:20]
    search = Search(tree, queries)
    read = []
    pages = Search._pages
    monkeypatch.setattr(Search, "_pages", lambda self, *a: (read.append(p) or p for p in pages(self, *a)))
    for k, q in enumerate(queries):
        scores = vectors @ q
        ids, found = search.best(k, labels[k], 7)
        want = sorted((-s, i) for i, s in enumerate(scores) if labels[i] == labels[k])[:7]
        assert [(-int(s), int(i)) for i, s in zip(ids, found, strict=True)] == want
        windows = [(5, 20), (-30, -20), (400, 500)]
        for (a, b), (ids, found) in zip(windows, search.within(k, labels[k], windows, 4), strict=True):
            want = sorted((-s, i) for i, s in enumerate(scores) if labels[i] != labels[k] and a <= s <= b)[:4]
            assert [(-int(s), int(i)) for i, s in zip(ids, found, strict=True)] == want
    assert len(read) < 2 * len(queries) * tree.leaves / 3


def test_scores_beyond_floating_point_are_exact():
    vectors = np.array([[2**31 - 1, 2**30 + 1], [2**31 - 3, 2**30 + 2], [3, 5]], np.int64)
    tree = Tree.of(np.arange(3), np.zeros(3, np.int64), vectors)
    ids, scores = Search(tree, vectors[:1]).best(0, 0, 3)
    assert ids.tolist() == [0, 1, 2] and scores.tolist() == (vectors @ vectors[0]).tolist()


def test_queries_of_a_block_read_their_pages_together(monkeypatch):
    random = np.random.default_rng(3)
    vectors, labels, ids = random.integers(-99, 99, (1500, 16)), random.integers(0, 3, 1500), random.permutation(1500)
    tree = Tree.of(ids, labels, vectors, 16, 4)
    place = {int(i): k for k, i in enumerate(ids)}
    search, read = Search(tree, vectors[:300]), []
    one = Search._read
    monkeypatch.setattr(Search, "_read", lambda self, *a: read.append(a[0]) or one(self, *a))
    rows, found, scores = search.best_of(np.arange(300), labels[:300], 4)
    owner = np.repeat(np.arange(300), 2)
    low, high = np.tile([20_000, -5_000], 300), np.tile([60_000, -4_000], 300)
    windows, other, other_scores = search.within_of(np.arange(300), labels[:300], owner, low, high, 3)
    every = vectors @ vectors[:300].T
    for k in range(300):
        want = sorted((-int(every[place[i], k]), i) for i in range(1500) if labels[place[i]] == labels[k])[:4]
        assert list(zip((-scores[rows == k]).astype(int).tolist(), found[rows == k].tolist(), strict=True)) == want
        for w in (2 * k, 2 * k + 1):
            want = sorted((-int(s), i) for i in range(1500) if labels[place[i]] != labels[k] and low[w] <= (s := every[place[i], k]) <= high[w])[:3]
            assert list(zip((-other_scores[windows == w]).astype(int).tolist(), other[windows == w].tolist(), strict=True)) == want
    rounds = 2 + int(np.log2(tree.leaves))
    assert len(read) <= 2 * rounds * tree.leaves  # and not one of each page for each query
