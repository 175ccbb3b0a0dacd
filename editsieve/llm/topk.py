"""Exact top-k by inner product with an impact-ordered index, score at a time.

Each block of vectors is indexed by dimension: a posting list holds the vectors in the order of their component, cut
into segments of equal quantised impact. A query takes segments of all lists in the descending order of their largest
contribution. An unread component of a vector contributes no more than the next segment of its list, so bounds hold at
every point; reading stops only when they prove that few vectors can still be among the best, and these are rescored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from editsieve.llm import grid

SCALE = 256
LEVELS = 8
STOPS = (0.55, 0.7, 0.85, 1.0)  # shares of all postings, in the order of impact, after which a proof is tried
FEW = 0.2  # share of a block that is rescored without reading on


def quantised(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of each component."""
    return np.floor(vectors * scale).astype(np.int64)


@dataclass
class Impacts:
    """Posting lists of a block, by ascending component, and their segments of one quantised level each."""

    rows: np.ndarray  # dimension by position
    values: np.ndarray
    dimension: np.ndarray  # of each segment, with its slice of the list and the components at its ends
    begin: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray, levels: int = LEVELS) -> Impacts:
        order = np.argsort(vectors, axis=0, kind="stable").T.copy()
        values = np.take_along_axis(vectors.T, order, axis=1).astype(float)
        parts = []
        for j, line in enumerate(values):
            level = np.minimum(((line - line[0]) * levels / max(1.0, line[-1] - line[0])).astype(int), levels - 1)
            ends = np.append(np.flatnonzero(level[1:] != level[:-1]) + 1, len(line))
            parts.append((np.full(len(ends), j), np.append(0, ends[:-1]), ends))
        dimension, begin, end = (np.concatenate(x) for x in zip(*parts, strict=True))
        return cls(order, values, dimension, begin, end, values[dimension, begin], values[dimension, end - 1])


def best(asked_ids: np.ndarray, asked: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    """The ``k`` best vectors of a block for each query, the query's own row left out."""
    asked, vectors = quantised(asked), quantised(vectors)
    index = Impacts.of(vectors)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for number, query in zip(asked_ids, asked, strict=True):
        own = np.searchsorted(ids, number)
        own = own if own < len(ids) and ids[own] == number else -1
        rows = possible(index, vectors, query, k, own)
        score = vectors[rows] @ query
        order = np.lexsort((ids[rows], -score))[:k]
        out.append((np.full(len(order), number), ids[rows[order]], score[order]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (asked_ids[:0],) * 3


def possible(index: Impacts, vectors: np.ndarray, query: np.ndarray, k: int, own: int = -1) -> np.ndarray:
    """Rows that can be among the ``k`` best; every other row is proven to be below ``k`` rows."""
    count = len(vectors)
    if count <= max(64, 16 * k) or not query.any():
        return np.delete(np.arange(count), own) if own >= 0 else np.arange(count)
    weight = query.astype(float)
    up = weight > 0
    # impact of a component: its contribution above the least one of its dimension
    base = np.where(up, index.values[:, 0], index.values[:, -1])
    j = index.dimension
    impact = np.where(up[j], weight[j] * (index.high - base[j]), weight[j] * (index.low - base[j]))
    order = np.argsort(-impact, kind="stable")
    read = np.cumsum((index.end - index.begin)[order])
    rows = np.arange(count)
    for share in STOPS:
        upto = len(order) if share == 1.0 else int(np.searchsorted(read, share * read[-1]))
        # what is read of each list is a slice, from the end with the large impacts on
        edge = np.where(up, count, 0)
        chosen, rest = order[:upto], order[upto:]
        rising = up[j[chosen]]
        np.minimum.at(edge, j[chosen[rising]], index.begin[chosen[rising]])
        np.maximum.at(edge, j[chosen[~rising]], index.end[chosen[~rising]])
        # unread components have at most the impact of the next segment of their list
        left = np.zeros(len(query))
        np.maximum.at(left, j[rest], impact[rest])
        parts = [(d, slice(edge[d], count) if up[d] else slice(0, edge[d])) for d in np.flatnonzero(weight)]
        gain = np.concatenate([weight[d] * index.values[d, part] - (weight[d] * base[d] + left[d]) for d, part in parts])
        bound = np.bincount(np.concatenate([index.rows[d, part] for d, part in parts]), gain, count) + left.sum()
        if own >= 0:
            bound[own] = -np.inf
        best_now = np.argpartition(bound, count - 2 * k)[count - 2 * k :]
        sure = np.sort(vectors[best_now[bound[best_now] > -np.inf]] @ query)[-k]
        rows = np.flatnonzero(bound >= sure - weight @ base)
        if len(rows) <= FEW * count:
            break
    return rows


def top_k(rows: DataFrame, asked, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``k`` highest inner products of quantised vectors; ties to smaller id.

    ``asked`` is a condition on ``vec_id``. Rows whose id or vector is null, or whose vector holds a null or
    non-finite component, take no part; only vectors of one length meet. Of rows with equal ids one stays.
    """

    def work(asked_ids, queries, ids, vectors):
        return best(asked_ids, queries, ids, vectors, k)

    return grid.search(rows, asked, work, "long", k, id_col, vec_col)
