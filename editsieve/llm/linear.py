"""Logistic regression on sparse rows, for samples of a bounded size."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from editsieve.llm.words import mix
from editsieve.session import cut_lineage


@dataclass
class Sparse:
    """Rows of (column, value) entries behind each other."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    rows: int
    columns: int

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.column], self.rows)

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * values[self.row], self.columns)

    def take(self, keep: np.ndarray) -> Sparse:
        moved = np.cumsum(keep) - 1
        some = keep[self.row]
        return Sparse(moved[self.row[some]], self.column[some], self.value[some], int(keep.sum()), self.columns)

    def beside(self, dense: np.ndarray) -> Sparse:
        """With the columns of ``dense`` behind the others."""
        rows, more = dense.shape
        return Sparse(
            np.concatenate([self.row, np.repeat(np.arange(rows), more)]),
            np.concatenate([self.column, np.tile(np.arange(self.columns, self.columns + more), rows)]),
            np.concatenate([self.value, dense.ravel()]), self.rows, self.columns + more,
        )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit(x: Sparse, y: np.ndarray, penalty: float, rounds: int = 100, memory: int = 8) -> tuple[np.ndarray, float]:
    """Weights and intercept by limited-memory quasi-Newton steps. Only one class: its smoothed rate, no weights."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(x.columns), float(logit(np.array(rate)))

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = x.times(w[:-1]) + w[-1]
        loss = np.logaddexp(0, z).sum() - z @ y + penalty / 2 * (w[:-1] @ w[:-1])
        miss = sigmoid(z) - y
        return loss, np.append(x.transposed_times(miss) + penalty * w[:-1], miss.sum())

    w = np.append(np.zeros(x.columns), logit(np.array(rate)))
    loss, slope = value(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way = slope.copy()
        used = []
        for s, g in reversed(steps):
            a = (s @ way) / (s @ g)
            used.append(a)
            way -= a * g
        way *= (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1]) if steps else 1 / max(1.0, np.abs(slope).max())
        for (s, g), a in zip(steps, reversed(used), strict=True):
            way += (a - (g @ way) / (s @ g)) * s
        size, down = 1.0, slope @ way
        while size > 1e-8:
            new = w - size * way
            new_loss, new_slope = value(new)
            if new_loss <= loss - 1e-4 * size * down:
                break
            size /= 2
        else:
            break
        if (new - w) @ (new_slope - slope) > 1e-12:
            steps = [*steps[-memory + 1 :], (new - w, new_slope - slope)]
        done = loss - new_loss < 1e-6 * max(1.0, abs(loss))
        w, loss, slope = new, new_loss, new_slope
        if done:
            break
    return w[:-1], float(w[-1])


def labelled(docs: DataFrame, labels: DataFrame, columns: list[str], id_col: str, text_col: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled documents, chosen by a hash of the id: id, text and the label columns.

    A label that differs between rows of one id is null, like one that is not given; ids without any label are left
    out. Of the rows of one id the one with the least hash of its text counts, so that a repeated id is one document.
    The sample of labels is what is broadcast; the sample of documents is written once, as it is read several times.
    """
    agreed = [F.when(F.min(x) == F.max(x), F.min(x)).alias(x) for x in columns]
    chosen = labels.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(*agreed)
    chosen = chosen.filter(F.coalesce(*columns).isNotNull()).orderBy(F.xxhash64(id_col), id_col).limit(limit)
    held = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)
    return cut_lineage(held.groupBy(id_col, *columns).agg(F.min_by(text_col, F.xxhash64(text_col)).alias(text_col)).select(id_col, text_col, *columns))


def folds(ids: np.ndarray, count: int) -> np.ndarray:
    """Fold of each id, independent of order."""
    return (mix(ids.astype(np.int64).view(np.uint64), 31) % np.uint64(count)).astype(np.int64)
