"""Removal of word windows that also start in an earlier document.

A count-min sketch of all windows is built first. Each chunk of documents sends the occupied counters of its own
sketch, four bytes per distinct window; the parts of the sketch are merged by addition, and one bit per counter goes
back: estimated to be repeated, or not. An estimate is never too low, so no repeated window is lost. Only windows
estimated to be repeated are then sent whole (96 bits and the first document) and grouped exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from editsieve.llm import exchange
from editsieve.llm.words import Words, runs, split_words

WINDOW = 13
_LAST = np.iinfo(np.int64).max
_COUNTERS_PER_KEY = 8


def remove_repeated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, chunk_bytes: int = exchange.CHUNK_BYTES
) -> DataFrame:
    """``docs`` with the kept words of each text, joined by one space, and ``n_words`` and ``n_removed``.

    A word goes if a window of ``window`` words covers it that also starts in a document with a smaller id; windows
    are judged on the input. Whole texts, all rows. A null text has no words and becomes an empty text. A null id
    counts as the largest. Rows of equal id do not remove each other's words. Columns named ``n_words`` or
    ``n_removed`` are replaced; all others are kept. A worker holds the arrays of ``chunk_bytes`` of text at once.
    """
    docs = docs.drop("n_words", "n_removed")
    chunks = exchange.pack(docs, text_col, chunk_bytes)
    parts = exchange.parts_of(chunks)

    def sketch(table: pa.Table):
        keys, counts = np.unique(_windows(split_words(table.column(text_col)), window)[0], return_counts=True)
        bounds = exchange.part_bounds(keys, parts)
        for part in np.flatnonzero(np.diff(bounds)):
            a, b = bounds[part], bounds[part + 1]
            yield int(part), keys[a:b].astype(np.uint32).tobytes() + np.packbits(counts[a:b] > 1).tobytes()

    def estimates(_: int, sent: list[memoryview]) -> list[bytes]:
        sizes = [_entries(len(m)) for m in sent]
        key = np.concatenate([np.frombuffer(m, np.uint32, n) for m, n in zip(sent, sizes, strict=True)])
        twice = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8, offset=4 * n), count=n) for m, n in zip(sent, sizes, strict=True)])
        width = 1 << max(10, int(len(key) * _COUNTERS_PER_KEY - 1).bit_length())
        repeated = np.ones(len(key), bool)
        for at in (key & np.uint32(width - 1), (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - width.bit_length() + 1)):
            counters = np.bincount(at, weights=twice + np.uint8(1), minlength=width)
            repeated &= counters[at] > 1
        return [np.packbits(x).tobytes() for x in np.split(repeated, np.cumsum(sizes)[:-1])]

    answers = exchange.answer(exchange.send(chunks, sketch), estimates)

    def candidates(number: int, table: pa.Table, got: list) -> pa.Table:
        words = split_words(table.column(text_col))
        key, start = _windows(words, window)
        keys, at = np.unique(key, return_index=True)  # rows are not ordered by id, so the first is found below
        bounds = exchange.part_bounds(keys, parts)
        may = np.zeros(len(keys), bool)
        for part, bits in got:
            a, b = bounds[part], bounds[part + 1]
            may[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        second = runs(words.hashes(family=1), words.row, window, 1)[0][at]
        first = _first_ids(keys, key, _ids(table, id_col)[words.row[start]])
        keys, second, first = keys[may], second[may], first[may]
        bounds = exchange.part_bounds(keys, parts)
        sent = [
            (int(p), keys[a:b].tobytes() + first[a:b].tobytes() + second[a:b].astype(np.uint32).tobytes())
            for p in np.flatnonzero(np.diff(bounds)) for a, b in [(bounds[p], bounds[p + 1])]
        ]
        return pa.Table.from_batches([exchange.messages(number, iter(sent))])

    def exact(_: int, sent: list[memoryview]) -> list[bytes]:
        sizes = [len(m) // 20 for m in sent]
        key = np.concatenate([np.frombuffer(m, np.uint64, n) for m, n in zip(sent, sizes, strict=True)])
        first = np.concatenate([np.frombuffer(m, np.int64, n, 8 * n) for m, n in zip(sent, sizes, strict=True)])
        second = np.concatenate([np.frombuffer(m, np.uint32, n, 16 * n) for m, n in zip(sent, sizes, strict=True)])
        order = np.lexsort((first, second, key))
        new = np.ones(len(order), bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (second[order][1:] != second[order][:-1])
        least = first[order][new][np.cumsum(new) - 1]
        earlier = np.zeros(len(order), bool)
        earlier[order] = least < first[order]
        ends = np.cumsum(sizes)
        return [key[b - n : b][earlier[b - n : b]].tobytes() or None for b, n in zip(ends, sizes, strict=True)]

    found = exchange.answer(exchange.with_answers(chunks, answers, candidates, exchange.SENT_DDL), exact)
    kept_columns = docs.columns
    schema = exchange.extended(docs.schema, "n_words long, n_removed long")

    def kept(_: int, table: pa.Table, got: list) -> pa.Table:
        words = split_words(table.column(text_col))
        key, start = _windows(words, window)
        ids = _ids(table, id_col)
        keys = np.unique(key)
        first = _first_ids(keys, key, ids[words.row[start]])
        gone = np.concatenate([np.frombuffer(m, np.uint64) for _, m in got]) if got else np.zeros(0, np.uint64)
        earlier = np.zeros(len(keys), bool)
        earlier[np.searchsorted(keys, gone)] = True
        at = np.searchsorted(keys, key)
        repeated = start[earlier[at] | (first[at] < ids[words.row[start]])]
        steps = np.zeros(len(words) + 1, np.int64)
        np.add.at(steps, repeated, 1)
        np.add.at(steps, repeated + window, -1)
        keep = np.cumsum(steps[:-1]) == 0
        rows = table.num_rows
        n_words = np.diff(words.first)
        n_kept = np.bincount(words.row[keep], minlength=rows) if len(words) else np.zeros(rows, np.int64)
        out = {name: table.column(name) for name in kept_columns} | {text_col: _joined(words, keep)}
        out |= {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_words - n_kept, pa.int64())}
        return pa.table(out)

    return exchange.with_answers(chunks, found, kept, schema)


def _entries(size: int) -> int:
    """Keys in a message of ``size`` bytes: four bytes and one bit each."""
    return size * 8 // 33


def _windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    return runs(words.hashes(), words.row, window)


def _ids(table: pa.Table, id_col: str) -> np.ndarray:
    return pc.fill_null(table.column(id_col).cast(pa.int64()), _LAST).to_numpy()


def _first_ids(keys: np.ndarray, key: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each of the sorted ``keys``."""
    first = np.full(len(keys), _LAST, np.int64)
    np.minimum.at(first, np.searchsorted(keys, key), ids)
    return first


def _joined(words: Words, keep: np.ndarray) -> pa.Array:
    """Kept words of each row joined by one space."""
    size, rows = len(words.data), len(words.offsets) - 1
    start, end, row = words.start[keep], words.end[keep], words.row[keep]
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    data = words.data.copy()
    data[end[~last]] = 0x20  # the separator after a word that another follows
    steps = np.zeros(size + 1, np.int8)
    steps[start] += 1
    stop = end + ~last
    np.subtract.at(steps, stop, 1)
    mask = np.cumsum(steps[:-1], dtype=np.int8) > 0
    lengths = np.add.reduceat(np.append(mask, False), words.offsets[:-1], dtype=np.int64) if rows else np.zeros(0, np.int64)
    lengths[np.diff(words.offsets) == 0] = 0
    offsets = np.zeros(rows + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    out = pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(data[mask]))
    return out.cast(pa.string())
