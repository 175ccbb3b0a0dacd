"""Numpy distance kernels that run inside tasks on one bounded block of vectors."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Workers get these functions with the task, whether or not the package is on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

METRICS = ("euclidean", "cosine")
NO_ID = np.iinfo(np.int64).max
TILE_ROWS = 512
_TILE_VALUES = 1 << 21  # distances that are held at a time
_BOUND_ROWS = 4096
_EXACT_PAIRS = 1 << 17
_GROUPS = 256  # of columns, whose least values bound the nearest
_FEW = 16  # times as many pairs as are kept are not too many for exact distances
_BOX_ROWS = 256  # near rows whose bounds in the main directions may tell that no other box has a neighbour
_DIRECTIONS = 8
_TINY = 1e-30  # underflow of single precision, at a scale of 1
_HUGE = 1e100  # vectors whose squares may overflow are left to the plain way
_SNAP = 1e-12  # cosine distances this small are rounding noise of parallel vectors


def stack(column) -> np.ndarray:
    """An Arrow list column of equal lengths as an n x width matrix of doubles."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(values) and len(pc.unique(pc.list_value_length(values))) > 1:
        raise ValueError("vectors of different lengths cannot be compared")
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(values), -1)


def padded(column) -> np.ndarray:
    """An Arrow list column of ids as a matrix, short rows filled with NO_ID."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = values.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(values), int(lengths.max(initial=1))), NO_ID, dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values.flatten().to_numpy(zero_copy_only=False)
    return out


def unit_rows(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length 1 (zero rows stay zero) and their lengths."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    return vectors / np.where(lengths > 0, lengths, 1.0)[:, None], lengths


def _rough(metric, a, b):
    """Comparable values by one matrix product, and per row how far off they may be.

    Squared distances for euclidean, distances for cosine.
    """
    if metric == "cosine":
        unit_a, length_a = unit_rows(a)
        unit_b, length_b = unit_rows(b)
        rough = 1.0 - unit_a @ unit_b.T
        rough[length_a == 0] = 0.0
        rough[:, length_b == 0] = 0.0
        return rough, np.full(len(a), 1e-11)
    square_a, square_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
    rough = a @ b.T
    rough *= -2.0
    rough += square_a[:, None]
    rough += square_b
    return rough, 1e-11 * (square_a + square_b.max(initial=0.0))


def _exact(metric, a, b, rows, columns):
    """Distances of the chosen pairs, from differences rather than products."""
    out = np.empty(len(rows))
    for start in range(0, len(rows), _EXACT_PAIRS):
        piece = slice(start, start + _EXACT_PAIRS)
        left, right = a[rows[piece]], b[columns[piece]]
        if metric == "euclidean":
            out[piece] = np.sqrt(((left - right) ** 2).sum(axis=1))
            continue
        lengths = np.sqrt((left * left).sum(axis=1) * (right * right).sum(axis=1))
        cosine = (left * right).sum(axis=1) / np.where(lengths > 0, lengths, 1.0)
        distance = np.where(lengths > 0, 1.0 - cosine, 0.0)
        out[piece] = np.where(np.abs(distance) < _SNAP, 0.0, distance)
    return out


def _boxes(space):
    """Rows in boxes of about ``_BOX_ROWS``, halved in the widest direction."""
    left, done = [np.arange(len(space))], []
    while left:
        rows = left.pop()
        if len(rows) <= _BOX_ROWS:
            done.append(rows)
            continue
        widest = np.ptp(space[rows], axis=0).argmax()
        order = rows[np.argpartition(space[rows, widest], len(rows) // 2)]
        left += [order[:len(rows) // 2], order[len(rows) // 2:]]
    return done


def _boxes_that_meet(a, b, keep, threshold):
    """Pairs of rows of ``a`` and all rows of ``b`` that may be among their ``keep`` nearest; None if most meet most.

    A box of rows spans an interval in each of the main directions of ``b``, which bounds distances to other boxes from
    below. From above they are bound by the threshold and by the ``keep`` nearest in the nearest box.
    """
    if min(len(a), len(b)) < 2 * _BOX_ROWS:
        return None
    centre = b.mean(axis=0)
    a, b = a - centre, b - centre
    directions = np.linalg.eigh(b.T @ b)[1][:, -_DIRECTIONS:]
    along_a, along_b = a @ directions, b @ directions
    boxes_a, boxes_b = _boxes(along_a), _boxes(along_b)
    low_a, high_a = (np.array([f(along_a[rows], axis=0) for rows in boxes_a]) for f in (np.min, np.max))
    low_b, high_b = (np.array([f(along_b[rows], axis=0) for rows in boxes_b]) for f in (np.min, np.max))
    off = 1e-9 * (np.abs(along_a).max() + np.abs(along_b).max())
    sizes, met, pairs = np.array([len(rows) for rows in boxes_b]), [], 0
    for rows, low, high in zip(boxes_a, low_a, high_a, strict=True):
        gaps = np.maximum(np.maximum(low_b - high, low - high_b), 0.0)
        apart = np.sqrt((gaps * gaps).sum(axis=1))
        limit = np.inf if threshold is None else threshold
        near = b[boxes_b[np.argmin(((low_b + high_b - low - high) ** 2).sum(axis=1))]]
        if len(near) >= keep:
            some = a[rows]
            square = (some * some).sum(axis=1)[:, None] + (near * near).sum(axis=1) - 2 * (some @ near.T)
            square += 1e-11 * ((some * some).sum(axis=1).max() + (near * near).sum(axis=1).max())
            limit = min(limit, float(np.sqrt(np.maximum(np.partition(square, keep - 1, axis=1)[:, keep - 1], 0.0).max())))
        chosen = np.flatnonzero(apart <= limit * (1 + 1e-9) + off)
        pairs += len(rows) * int(sizes[chosen].sum())
        met.append((rows, chosen))
    if pairs > len(a) * len(b) / 2:
        return None
    return [(rows, np.concatenate([boxes_b[k] for k in chosen])) for rows, chosen in met if len(chosen)]


def _may_be_nearest(a, b, keep, threshold):
    """For each tile of rows of ``a`` its start and the pairs of which some may be among the ``keep`` nearest of the row.

    One product gives, for each pair, the squared distance without the row's own square and less than it may be off. The
    least of every ``_GROUPS``-th column bound it from above: ``keep`` of these are ``keep`` different columns. Single
    precision is tried first; where it leaves too many pairs, double precision decides. Both sides are moved to the centre
    of ``b`` and scaled, so that what a number is off depends on the spread of the vectors and not on where they lie.
    """
    centre = b.mean(axis=0)
    a, b = a - centre, b - centre
    largest = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0)) or 1.0
    a, b = a / largest, b / largest
    square_a, square_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
    limit = np.inf if threshold is None else (threshold / largest) ** 2
    width = b.shape[1]
    groups = min(_GROUPS, len(b))
    full = len(b) // groups * groups
    sides = {}

    def side(kind):
        if kind not in sides:
            off = 4 * float(np.finfo(kind).eps) * (width + 4)
            sides[kind] = off, np.column_stack([a, np.ones(len(a))]).astype(kind), np.column_stack([-2 * b, square_b * (1 - off)]).astype(kind).T.copy()
        return sides[kind]

    def chosen(kind, start, stop):
        off, left, right = side(kind)
        rough = left[start:stop] @ right
        own = square_a[start:stop]
        bound = limit - own + off * (2 * own + (limit if threshold is not None else 0.0))
        if keep <= groups:
            least = rough[:, :full].reshape(len(rough), -1, groups).min(axis=1)
            kth = np.partition(least, keep - 1, axis=1)[:, keep - 1].astype(np.float64)
            bound = np.minimum(bound, kth + off * (7 * own + 5 * np.maximum(kth + own, 0.0)))
        near = rough <= (bound + _TINY)[:, None].astype(kind)
        return np.divmod(np.flatnonzero(near), near.shape[1])

    step = min(TILE_ROWS, max(16, _TILE_VALUES // max(1, len(b))))
    for start in range(0, len(a), step):
        stop = min(start + step, len(a))
        rows, columns = chosen(np.float32, start, stop)
        if len(rows) > _FEW * (stop - start) * keep:
            rows, columns = chosen(np.float64, start, stop)
        yield start, rows, columns


def lowest_per_row(rows, distances, ids, keep):
    """Positions of the ``keep`` lowest (distance, id) of each row."""
    order = np.lexsort((ids, distances, rows))
    sorted_rows = rows[order]
    first = np.r_[True, sorted_rows[1:] != sorted_rows[:-1]] if len(order) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[place < keep]


def nearest(metric, keep, identical, threshold, a, a_key, b, b_key, b_ids):
    """For each row of ``a`` the ``keep`` lowest (distance, id) among the ids of ``b``'s rows.

    A rough pass picks every row that may belong, the exact distance decides. With ``identical``
    false, distance 0 does not count; with a threshold, only smaller distances count.
    Returns row numbers of ``a``, ids and distances.
    """
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for start, rows, columns in _candidates(metric, keep, identical, threshold, a, a_key, b, b_key):
        distances = _exact(metric, a[start:], b, rows, columns)
        good = np.ones(len(rows), bool) if identical else distances > 0
        if threshold is not None:
            good &= distances < threshold
        rows, columns, distances = rows[good], columns[good], distances[good]
        best = lowest_per_row(rows, distances, b_key[columns], keep)
        rows, columns, distances = rows[best], columns[best], distances[best]
        width = b_ids.shape[1]
        ids = b_ids[columns].ravel()
        rows, distances = np.repeat(rows, width), np.repeat(distances, width)
        real = ids != NO_ID
        rows, ids, distances = rows[real], ids[real], distances[real]
        best = lowest_per_row(rows, distances, ids, keep)
        found.append((rows[best] + start, ids[best], distances[best]))
    return tuple(np.concatenate(part) for part in zip(*found))


def _candidates(metric, keep, identical, threshold, a, a_key, b, b_key):
    """Tiles of rows of ``a``: where each starts, and the rows in it and of ``b`` of every pair that may belong."""
    if not len(a) or not len(b):
        return
    if metric == "euclidean" and identical and max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0)) < _HUGE:
        met = _boxes_that_meet(a, b, keep, threshold)
        for rows, columns in met if met is not None else ():
            for start, left, right in _may_be_nearest(a[rows], b[columns], keep, threshold):
                yield 0, rows[start + left], columns[right]
        if met is None:
            yield from _may_be_nearest(a, b, keep, threshold)
        return
    step = min(TILE_ROWS, max(16, _TILE_VALUES // max(1, len(b))))
    for start in range(0, len(a), step):
        tile, tile_key = a[start:start + step], a_key[start:start + step]
        rough, slack = _rough(metric, tile, b)
        if not identical:
            rough[tile_key[:, None] == b_key[None, :]] = np.inf
            if metric == "cosine":
                rough[rough < _SNAP * 10] = np.inf
        if threshold is not None:
            limit = threshold if metric == "cosine" else threshold * threshold
            rough[rough > limit + slack[:, None]] = np.inf
        some = rough[:, ::max(1, len(b) // _BOUND_ROWS)]  # the lowest of some columns bound those of all
        last = min(keep, some.shape[1]) - 1
        bound = np.partition(some, last, axis=1)[:, last] + 2 * slack
        rows, columns = np.nonzero((rough <= bound[:, None]) & np.isfinite(rough))
        yield start, rows, columns


def pairs_below(metric, threshold, a, b):
    """Row numbers and distances of all pairs nearer than ``threshold``."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    limit = threshold if metric == "cosine" else threshold * threshold
    step = min(TILE_ROWS, max(16, _TILE_VALUES // max(1, len(b))))
    for start in range(0, len(a) if len(b) else 0, step):
        tile = a[start:start + step]
        rough, slack = _rough(metric, tile, b)
        rows, columns = np.nonzero(rough <= limit + slack[:, None])
        distances = _exact(metric, tile, b, rows, columns)
        good = distances < threshold
        found.append((rows[good] + start, columns[good], distances[good]))
    return tuple(np.concatenate(part) for part in zip(*found))


def runs(*keys: np.ndarray):
    """Index arrays of the rows that share all keys."""
    if not len(keys[0]):
        return
    order = np.lexsort(keys)
    changed = np.zeros(len(order), bool)
    for key in keys:
        ordered = key[order]
        changed[1:] |= ordered[1:] != ordered[:-1]
    yield from np.split(order, np.flatnonzero(changed))


def may_meet(number: int, centres, radius, reach, chosen=slice(None)) -> np.ndarray:
    """Which of the ``chosen`` may hold a neighbour of ``number`` or the reverse, by the triangle inequality."""
    apart = np.sqrt(((centres[chosen] - centres[number]) ** 2).sum(axis=1)) - radius[number] - radius[chosen]
    near = apart * (1 - 1e-9) - 1e-9 <= np.maximum(reach[number], reach[chosen])
    return near | (np.arange(len(centres))[chosen] == number)


def nearest_pairs(pairs: list, nearest: int) -> tuple:
    low, high, distance = (np.concatenate(part) for part in zip(*pairs))
    best = lowest_per_row(low, distance, high, nearest)
    return low[best], high[best], distance[best]


class Tiles:
    """The rows of a pair of tiles by slices, each with the rows of its partners."""

    def __init__(self, table: pa.Table):
        number = table["slice"].to_numpy()
        order = np.argsort(number, kind="stable")
        self.gids = table["gid"].to_numpy()[order]
        self.space = stack(table["vec"])[order]
        self.ids = padded(table["ids"])[order]
        self.slices, starts = np.unique(number[order], return_index=True)
        self.bounds = np.r_[starts, len(number)]
        named = table.filter(pc.is_valid(table["partners"]))
        self.partners = dict(zip(named["slice"].to_pylist(), named["partners"].to_pylist(), strict=True))

    def meetings(self, upper: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The rows of each slice and those of its partners; with ``upper`` only of partners from itself on.

        Slices that follow each other and have the same partners come together: a partner is prepared once for them.
        """
        met = [[p for p in self.partners[one] if not upper or p >= one] for one in self.slices]
        at = 0
        while at < len(met):
            to = at + 1
            while to < len(met) and met[to] == met[at]:
                to += 1
            if met[at]:
                rows = [np.arange(self.bounds[p], self.bounds[p + 1]) for p in np.searchsorted(self.slices, met[at])]
                yield np.arange(self.bounds[at], self.bounds[to]), np.concatenate(rows)
            at = to
