"""Approximate nearest neighbours by cosine with forests of random-projection trees.

Each block of vectors has a forest of its own: a node splits its vectors at the median of their projection onto a
random direction. A query descends all trees at once: one priority queue holds the branches not taken of every tree, by
how far the query is from their side, and the nearest branch of the whole forest is searched next, until enough
candidates are found. The candidates are compared exactly on the original vectors.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from editsieve.llm import grid

TREES = 24
LEAF = 16
#: Share of a block that is compared exactly. The recall that it gives on given vectors is in the README.
SEARCHED = 0.6
LEAST = 512  # rows that are compared in any case
SEED = 7


@dataclass
class Tree:
    """Node k splits at ``offset`` along direction k; children 2k + 1 and 2k + 2; leaves are slices of ``rows``."""

    direction: np.ndarray
    offset: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    rows: np.ndarray
    depth: int

    @classmethod
    def of(cls, vectors: np.ndarray, leaf: int, random: np.random.Generator) -> Tree:
        count = len(vectors)
        depth = max(0, int(np.ceil(np.log2(max(1, count / leaf)))))
        inner = (1 << depth) - 1
        direction = random.standard_normal((inner, vectors.shape[1])) if inner else np.zeros((0, vectors.shape[1]))
        offset = np.zeros(inner)
        begin, end = np.zeros(2 * inner + 1, np.int64), np.zeros(2 * inner + 1, np.int64)
        end[0], rows = count, np.arange(count)
        for node in range(inner):
            a, b = begin[node], end[node]
            along = vectors[rows[a:b]] @ direction[node]
            order = np.argsort(along, kind="stable")
            rows[a:b] = rows[a:b][order]
            middle = (a + b) // 2
            offset[node] = along[order[(b - a) // 2]] if b > a else 0.0
            begin[2 * node + 1], end[2 * node + 1] = a, middle
            begin[2 * node + 2], end[2 * node + 2] = middle, b
        return cls(direction, offset, begin, end, rows, depth)


class Forest:
    def __init__(self, vectors: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.count = len(vectors)
        self.trees = [Tree.of(vectors, leaf, random) for _ in range(trees)]

    def candidates(self, query: np.ndarray, enough: int) -> np.ndarray:
        """At least ``enough`` rows, or all."""
        if enough >= self.count:
            return np.arange(self.count)
        # distance of the query from each split, per tree
        sides = [(t.direction @ query - t.offset) / np.linalg.norm(t.direction, axis=1).clip(1e-12) for t in self.trees]
        sides = [s.tolist() for s in sides]
        queue = [(0.0, k, 0) for k in range(len(self.trees))]
        taken = np.zeros(self.count, bool)
        found, waiting = 0, 0
        while queue and found < enough:
            far, k, node = heapq.heappop(queue)
            side, inner = sides[k], len(sides[k])
            while node < inner:
                away = side[node]
                near, other = (2 * node + 2, 2 * node + 1) if away >= 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (max(far, abs(away)), k, other))
                node = near
            tree = self.trees[k]
            taken[tree.rows[tree.begin[node] : tree.end[node]]] = True
            waiting += 1
            if waiting % 8 == 0:
                found = int(np.count_nonzero(taken))
        return np.flatnonzero(taken)


def best(asked_ids: np.ndarray, asked: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, searched: float):
    """The ``k`` nearest found in a block for each query, the query's own row left out."""
    with np.errstate(over="ignore"):
        norms, asked_norms = np.linalg.norm(vectors, axis=1), np.linalg.norm(asked, axis=1)
    units = vectors / norms[:, None]
    forest = Forest(units)
    out = []
    for number, query, norm in zip(asked_ids, asked, asked_norms, strict=True):
        rows = forest.candidates(query / norm, max(4 * k, LEAST, int(searched * len(ids))))
        rows = rows[ids[rows] != number]
        score = (vectors[rows] @ query) / (norms[rows] * norm)
        if len(rows) > 4 * k:
            keep = np.flatnonzero(score >= np.partition(score, len(rows) - k)[len(rows) - k])
            rows, score = rows[keep], score[keep]
        order = np.lexsort((ids[rows], -score))[:k]
        out.append((np.full(len(order), number), ids[rows[order]], score[order]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (asked_ids[:0], ids[:0], np.zeros(0))


def neighbours(
    rows: DataFrame, asked, k: int = 5, searched: float = SEARCHED, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine) of the ``k`` nearest found; ties to smaller id.

    ``asked`` is a condition on ``vec_id``. Every usable row is in a forest. Rows whose id or vector is null, or whose
    vector is zero or holds a null or non-finite component, take no part; only vectors of one length meet. Of rows
    with equal ids one stays. With ``searched=1`` the search is exact.
    """

    def work(asked_ids, queries, ids, vectors):
        some, others = (queries != 0).any(axis=1), (vectors != 0).any(axis=1)
        return best(asked_ids[some], queries[some], ids[others], vectors[others], k, searched)

    return grid.search(rows, asked, work, "double", k, id_col, vec_col)
