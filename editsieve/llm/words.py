"""Words of whole Arrow string columns as flat numpy arrays: positions, row numbers, 64-bit hashes.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. The hash of a word is a polynomial over a random
64-bit number per byte value, so that all words of a column are hashed by one cumulative sum.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

_SLICE = 1 << 20
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


@lru_cache(maxsize=1)
def _trim():
    name = ctypes.util.find_library("c")
    return getattr(ctypes.CDLL(name), "malloc_trim", None) if name else None


def release_memory() -> None:
    """Give what freed arrays held back to the system; a worker process lives on and would keep its largest size."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim is not None:
        trim(0)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers, different for each seed."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _byte_values(lower: bool, family: int) -> np.ndarray:
    values = mix(np.arange(256, dtype=np.uint64), 101 + family)
    if lower:
        values[65:91] = values[97:123]
    return values


@lru_cache(maxsize=2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x5851F42D4C957F2D
    out = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(length, factor, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


@dataclass
class Words:
    data: np.ndarray  # bytes of the column
    offsets: np.ndarray  # of the rows in data, one more than rows
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray  # row of each word
    first: np.ndarray  # index of the first word of each row, one more than rows

    def __len__(self) -> int:
        return len(self.start)

    def upto(self, length: int) -> Words:
        """The same words, cut after ``length`` bytes."""
        return Words(self.data, self.offsets, self.start, np.minimum(self.end, self.start + length), self.row, self.first)

    def hashes(self, lower: bool = False, family: int = 0) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        values = _byte_values(lower, family)
        at = 0
        while at < len(out):
            base = self.start[at]
            upto = max(at + 1, int(np.searchsorted(self.end, base + _SLICE, "right")))
            piece = self.data[base : self.end[upto - 1]]
            size = _SLICE
            while size < len(piece):
                size *= 2
            powers, inverse = _powers(size)
            total = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(values[piece] * powers[: len(piece)], out=total[1:])
            a, b = self.start[at:upto] - base, self.end[at:upto] - base
            out[at:upto] = mix((total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64))
            at = upto
        return out


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


WORD_BYTES = np.ones(256, bool)
WORD_BYTES[list(_SPACES)] = False
#: Letters of ASCII, and all bytes of other characters.
LETTER_BYTES = np.arange(256) >= 0x80
LETTER_BYTES[0x41:0x5B] = LETTER_BYTES[0x61:0x7B] = True


def split_words(column: pa.Array, word_bytes: np.ndarray = WORD_BYTES) -> Words:
    """Maximal runs of ``word_bytes`` within the rows."""
    data, offsets = bytes_of(column)
    return runs_inside(data, offsets, word_bytes[data])


def runs_inside(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """Maximal runs of the bytes marked in ``inside`` within the rows."""
    size = len(data)
    after = np.empty(size + 1, bool)  # a word cannot go on from the byte before
    after[0] = after[size] = True
    np.logical_not(inside[:-1], out=after[1:size]) if size else None
    after[offsets] = True
    start = np.flatnonzero(inside & after[:size])
    before = np.empty(size + 1, bool)  # a word cannot go on to the byte at this place
    before[size] = True
    np.logical_not(inside, out=before[:size])
    before[offsets] = True
    end = np.flatnonzero(inside & before[1:]) + 1
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, end, row, first)


def runs(hashes: np.ndarray, row: np.ndarray, length: int, family: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``length`` words within a row, and the index of its first word."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(count, np.uint64)
    factor = np.uint64(0xD1342543DE82EF95 + 2 * family)
    for j in range(length):
        total *= factor
        total += hashes[j : j + count]
    whole = row[:count] == row[length - 1 :]
    return mix(total[whole], 7 + family), np.flatnonzero(whole)
