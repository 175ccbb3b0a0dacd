"""An R-tree packed by sort-tile-recursion, searched best-first by inner product.

The box of a node bounds the inner product of a query with everything below it: each coordinate contributes between the
smaller and the larger of its products with the two sides of the box. A search takes pages by their upper bound, in rounds
of growing size; a node goes unread if its interval does not meet the score window or lies strictly below the k-th score
so far. Queries of a block search together, so that a page that many of them need is one matrix product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 64
FANOUT = 12
_EXACT = 2.0**53
_WAITING = 1 << 20  # found rows that wait to be ranked, at most about so many


def tile_recursively(vectors: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Order of the rows in which each ``leaf`` of them are a page.

    With p pages to fill and d coordinates left, the rows are sorted by the next coordinate and cut into p ** (1 / d)
    slabs, each of which goes on with the other coordinates. Coordinates come in the order of their variance.
    """
    count, dim = vectors.shape
    order = np.arange(count)
    axes = np.argsort(-vectors.astype(float).var(axis=0), kind="stable") if count else np.arange(dim)
    open_slabs = [(0, count)]
    for depth, axis in enumerate(axes):
        left, further = dim - depth, []
        for a, b in open_slabs:
            pages = -(-(b - a) // leaf)
            if pages <= 1:
                continue
            order[a:b] = order[a:b][np.argsort(vectors[order[a:b], axis], kind="stable")]
            if left == 1:
                continue
            slabs = int(np.ceil(round(pages ** (1 / left), 9)))
            each = -(-pages // slabs) * leaf
            further += [(at, min(at + each, b)) for at in range(a, b, each)]
        open_slabs = further
    return order


@dataclass
class Tree:
    """Rows in page order; ``low`` and ``high`` are the boxes of all nodes, root last; ``child`` their first children."""

    ids: np.ndarray
    label: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    begin: np.ndarray  # of a leaf: its rows; of another node: its children
    end: np.ndarray
    leaves: int

    @classmethod
    def of(cls, ids: np.ndarray, label: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT) -> Tree:
        order = tile_recursively(vectors, leaf)
        ids, label, vectors = ids[order], label[order], vectors[order]
        begin = np.arange(0, len(ids), leaf)
        low, high = np.minimum.reduceat(vectors, begin, axis=0), np.maximum.reduceat(vectors, begin, axis=0)
        boxes, spans = [(low, high)], [(begin, np.minimum(begin + leaf, len(ids)))]
        base, leaves = 0, len(begin)
        while len(low) > 1:
            begin = np.arange(0, len(low), fanout)
            spans.append((base + begin, base + np.minimum(begin + fanout, len(low))))
            base += len(low)
            low, high = np.minimum.reduceat(low, begin, axis=0), np.maximum.reduceat(high, begin, axis=0)
            boxes.append((low, high))
        low, high = (np.concatenate(x) for x in zip(*boxes, strict=True))
        begin, end = (np.concatenate(x) for x in zip(*spans, strict=True))
        return cls(ids, label, vectors, low, high, begin, end, leaves)

    def exact_kind(self, queries: np.ndarray) -> type:
        """Floating point only where it holds all scores and bounds exactly."""
        most = float(max(np.abs(self.low.astype(float)).max(), np.abs(self.high.astype(float)).max(), 1.0))
        asked = float(np.abs(queries.astype(float)).max(initial=1.0))
        return np.float64 if most * asked * queries.shape[1] < _EXACT else np.int64


class Search:
    """Searches of one tree by a block of queries, whose bounds with all nodes are two matrix products.

    The queries that read a page in the same round read it together, by one product.
    """

    def __init__(self, tree: Tree, queries: np.ndarray):
        self.tree = tree
        kind = tree.exact_kind(queries)
        low, high = tree.low.astype(kind), tree.high.astype(kind)
        self.queries, self.vectors = queries.astype(kind), tree.vectors.astype(kind)
        up, down = np.maximum(self.queries, 0), np.minimum(self.queries, 0)
        self.upper = up @ high.T + down @ low.T
        self.lower = up @ low.T + down @ high.T

    def _pages(self, numbers: np.ndarray, wanted):
        """Leaves, each with the rows of ``numbers`` that read it, as long as ``wanted`` (of matrices of lower and upper
        bounds, one line per row) says that they are needed.

        Below a node that is not wanted no leaf is read. Of the others each query takes the one of the largest upper bound,
        then the next 1, 2, 4 and so on; what it has found by then decides which of these it needs.
        """
        tree, leaves = self.tree, self.tree.leaves
        upper, lower = self.upper[numbers], self.lower[numbers]
        open_nodes = np.zeros(upper.shape, bool)
        open_nodes[:, -1] = True
        needed = wanted(lower, upper)
        for node in range(upper.shape[1] - 1, leaves - 1, -1):
            open_nodes[:, tree.begin[node] : tree.end[node]] = (open_nodes[:, node] & needed[:, node])[:, None]
        order = np.argsort(-upper[:, :leaves], axis=1, kind="stable")
        at = 0
        while at < leaves:
            some = order[:, at : at + max(1, at)]
            rows, place = np.nonzero(np.take_along_axis(open_nodes, some, 1) & wanted(np.take_along_axis(lower, some, 1), np.take_along_axis(upper, some, 1)))
            leaf = some[rows, place]
            by = np.argsort(leaf, kind="stable")
            ends = np.flatnonzero(np.diff(leaf[by])) + 1
            for group in np.split(by, ends) if len(by) else ():
                yield leaf[group[0]], rows[group]
            at += max(1, at)

    def _read(self, leaf: int, numbers: np.ndarray):
        """Ids and labels of a page, and its scores, a column per query."""
        page = slice(self.tree.begin[leaf], self.tree.end[leaf])
        return self.tree.ids[page], self.tree.label[page], self.vectors[page] @ self.queries[numbers].T

    def best_of(self, numbers: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each query the ``k`` best rows of its label, ties to smaller ids: rows of ``numbers``, ids and scores."""
        tops = Tops(len(numbers), k, self.vectors.dtype)
        for leaf, rows in self._pages(numbers, lambda low, high: high >= tops.merged()[:, None]):
            ids, label, scores = self._read(leaf, numbers[rows])
            at, who = np.nonzero((label[:, None] == labels[rows]) & (scores >= tops.least[rows]))
            tops.add(rows[who], ids[at], scores[at, who])
        tops.merged()
        return tops.rows, tops.ids, tops.scores

    def within_of(
        self, numbers: np.ndarray, labels: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each window of scores (ends included) the ``k`` best rows of other labels; one traversal for all windows.

        ``owner`` is the row of ``numbers`` of each window, ascending; every row has a window.
        """
        tops = Tops(len(owner), k, self.vectors.dtype)
        first = np.searchsorted(owner, np.arange(len(numbers)))
        count = np.diff(np.append(first, len(owner)))
        floor, ceiling = np.minimum.reduceat(low, first).astype(tops.least.dtype), np.maximum.reduceat(high, first)

        def wanted(lower, upper):
            least = np.maximum(low, tops.merged())
            floor[:] = np.minimum.reduceat(least, first)
            lower, upper = lower[owner], upper[owner]
            each = (lower <= high[:, None]) & (np.minimum(upper, high[:, None]) >= least[:, None])
            return np.logical_or.reduceat(each, first, axis=0)

        for leaf, rows in self._pages(numbers, wanted):
            ids, label, scores = self._read(leaf, numbers[rows])
            at, who = np.nonzero((scores >= floor[rows]) & (scores <= ceiling[rows]) & (label[:, None] != labels[rows]))
            times = count[rows[who]]
            window = np.repeat(first[rows[who]], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            ids, scores = np.repeat(ids[at], times), np.repeat(scores[at, who], times)
            keep = (scores >= low[window]) & (scores <= high[window]) & (scores >= tops.least[window])
            tops.add(window[keep], ids[keep], scores[keep])
        tops.merged()
        return tops.rows, tops.ids, tops.scores

    def best(self, number: int, label: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``best_of`` for one query: ids and scores."""
        return self.best_of(np.array([number]), np.array([label]), k)[1:]

    def within(self, number: int, label: int, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``within_of`` for one query: ids and scores of each window."""
        low, high = (np.array(x, np.int64) for x in zip(*windows, strict=True))
        rows, ids, scores = self.within_of(np.array([number]), np.array([label]), np.zeros(len(windows), np.int64), low, high, k)
        return [(ids[rows == w], scores[rows == w]) for w in range(len(windows))]


class Tops:
    """The ``k`` best so far of each of ``count`` rows: larger scores first, then smaller ids. ``least`` is the k-th score."""

    def __init__(self, count: int, k: int, kind: type):
        self.k = k
        self.least = np.full(count, -np.inf if kind == np.float64 else np.iinfo(np.int64).min, kind)
        self.rows, self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)
        self.added, self.waiting = [], 0

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.added.append((rows, ids, scores))
        self.waiting += len(rows)
        if self.waiting > _WAITING:
            self.merged()

    def merged(self) -> np.ndarray:
        """``least``, with all that was added."""
        if self.waiting:
            parts = zip((self.rows, self.ids, self.scores), *self.added, strict=True)
            rows, ids, scores = (np.concatenate(part) for part in parts)
            order = np.lexsort((ids, -scores, rows))
            starts = np.flatnonzero(np.append(True, np.diff(rows[order]) != 0))
            place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
            order, full = order[place < self.k], order[place == self.k - 1]
            self.rows, self.ids, self.scores = rows[order], ids[order], scores[order]
            self.least[rows[full]] = scores[full]
        self.added, self.waiting = [], 0
        return self.least
