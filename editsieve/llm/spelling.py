"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

The vocabulary is counted first. One edit changes the letter counts of a word in a known way: a replaced letter moves
one count, an inserted or deleted one adds or takes one, so near words are at most two apart in squared distance. Words
are blocked by length, and within a length by how many of their letters are in each of a few groups of the alphabet; an
edit leads to the same block or to one of a few neighbours there or in the adjacent length. Blocks meet as matrices: one
NumPy product gives the squared distances of all their words, what is at most two apart is verified letter by letter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from editsieve.llm import exchange
from editsieve.llm.words import Words, bytes_of, mix, runs_inside

LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5  # so much more frequent than the word itself its form has to be
TYPO_OF = 199
SLICE_BYTES = 4 << 20
TILE = 2048  # words of a block that meet at once
TASK_CELLS = 64
MOST_GROUPS = 16
_LONG = 64
_SYMBOLS = 26 + 64  # a-z, U+00C0-U+00FF
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[0x61:0x7B] = np.arange(26)
_SYMBOL[0xC0:0x100] = 26 + np.arange(64)
_U = np.uint64


# ---- words and their counts ----


def letter_runs(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Maximal runs of A-Z, a-z and U+00C0-U+00FF with A-Z lower-cased, and their lengths in code points.

    In UTF-8 the letters beyond ASCII are the byte 0xC3 and one more, and no other character has that byte.
    """
    data, offsets = bytes_of(texts)
    upper = (data >= 0x41) & (data <= 0x5A)
    data = np.where(upper, data | 0x20, data).astype(np.uint8)
    lead = data == 0xC3
    inside = (data >= 0x61) & (data <= 0x7A) | lead
    inside[1:] |= lead[:-1]
    found = runs_inside(data, offsets, inside)
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=leads[1:])
    return found, found.end - found.start - (leads[found.end] - leads[found.start])


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def checksums(words: Words, ids: list[int | None]) -> np.ndarray:
    """crc32 of ``<id of the row>:<word>`` of each word."""
    heads = np.array([zlib.crc32(b"%d:" % (k or 0)) for k in ids], np.uint32)
    out = heads[words.row]
    lengths = words.end - words.start
    for k in np.flatnonzero(lengths > _LONG):
        out[k] = zlib.crc32(words.data[words.start[k] : words.end[k]].tobytes(), int(out[k]))
    short = np.flatnonzero(lengths <= _LONG)
    order = short[np.argsort(-lengths[short], kind="stable")]
    state, start = out[order] ^ np.uint32(0xFFFFFFFF), words.start[order]
    upto = np.searchsorted(-lengths[order], -np.arange(_LONG))  # words longer than k bytes come first
    table = _crc_table()
    for k in range(_LONG):
        some = slice(0, upto[k])
        if not upto[k]:
            break
        state[some] = table[(state[some] ^ words.data[start[some] + k]) & np.uint32(0xFF)] ^ (state[some] >> np.uint32(8))
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _strings(words: Words, some: np.ndarray) -> pa.Array:
    start, sizes = words.start[some], words.end[some] - words.start[some]
    offsets = np.zeros(len(some) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    at = np.repeat(start - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(some), pa.py_buffer(offsets), pa.py_buffer(words.data[at])).cast(pa.string())


def _pick(words: Words, some: np.ndarray) -> Words:
    return Words(words.data, words.offsets, words.start[some], words.end[some], words.row[some], words.first)


def _shortened(word: bytes, check: int) -> str:
    text = word.decode()
    at = check % len(text)
    return text[:at] + text[at + 1 :]


def count_words(texts: pa.Array, ids: list[int | None], least: int = LEAST_LENGTH, typo_of: int = TYPO_OF) -> pa.RecordBatch:
    """(word, n) of one slice of documents, words of at least ``least`` code points."""
    found, length = letter_runs(texts)
    found = _pick(found, np.flatnonzero(length >= least))
    known = np.array([k is not None for k in ids], bool)
    check = checksums(found, ids)
    typo = (check % np.uint32(typo_of) == 0) & known[found.row]
    made = [
        _shortened(found.data[found.start[k] : found.end[k]].tobytes(), int(check[k])) for k in np.flatnonzero(typo)
    ]
    made = [w for w in made if len(w) >= least]
    whole = _pick(found, np.flatnonzero(~typo))
    _, at, n = np.unique(whole.hashes(), return_index=True, return_counts=True)
    words = pa.concat_arrays([_strings(whole, at), pa.array(made, pa.string())])
    return pa.RecordBatch.from_arrays([words, pa.array(np.append(n, np.ones(len(made), np.int64)))], ["word", "n"])


def vocabulary(docs: DataFrame, id_col: str, text_col: str, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: counted over all documents, kept from ``least_count`` occurrences on."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            _, offsets = bytes_of(texts)
            at = 0
            while at < batch.num_rows:
                upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
                yield count_words(texts.slice(at, upto - at), ids[at:upto])
                at = upto

    held = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    counts = held.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return exchange.written(counts.filter(F.col("n") >= least_count))


# ---- blocks ----


def letter_groups(letters: np.ndarray, groups: int) -> np.ndarray:
    """Group of each symbol, the groups of nearly equal weight: each symbol goes to the lightest, heavy ones first."""
    out, weight = np.zeros(_SYMBOLS, np.int64), np.zeros(groups)
    for symbol in np.argsort(-letters, kind="stable"):
        out[symbol] = np.argmin(weight)
        weight[out[symbol]] += letters[symbol]
    return out


def _latin(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words as one byte a letter behind each other, and where each begins."""
    data, offsets = bytes_of(words)
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    letters = np.where(second, data | 0x40, data).astype(np.uint8)  # C3 80-BF are U+00C0-U+00FF
    lead = data == 0xC3
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=before[1:])
    return letters[~lead], offsets - before[offsets]


def _letter_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_SYMBOLS, np.int64)
    for batch in batches:
        total += np.bincount(_SYMBOL[_latin(batch.column(0))[0]], minlength=_SYMBOLS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(_SYMBOLS)), pa.array(total)], ["symbol", "n"])


def _steps(groups: int) -> np.ndarray:
    """A block's key is the sum of its letters' group numbers, each a random 64-bit number, so neighbours are sums too."""
    return mix(np.arange(groups, dtype=_U), 77)


def _keyed(group: np.ndarray, groups: int):
    steps = _steps(groups)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, first = _latin(batch.column(0))
            total = np.zeros(len(letters) + 1, _U)
            np.cumsum(steps[group[_SYMBOL[letters]]], out=total[1:])
            key = total[first[1:]] - total[first[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(first).astype(np.int32)), pa.array(key.view(np.int64))],
                ["word", "n", "size", "key"],
            )

    return each


def blocked(words: DataFrame, tile: int = TILE) -> tuple[DataFrame, int]:
    """Words with length, block key and tile, and the number of letter groups.

    The more words, the more groups, so that the block of an average word stays below ``tile`` words at any size of the
    vocabulary. A larger block is cut into tiles by a hash, which all meet.
    """
    letters = np.zeros(_SYMBOLS)
    for r in words.select("word").mapInArrow(_letter_sums, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        letters[r["symbol"]] = r["n"]  # one row a symbol
    for groups in range(2, MOST_GROUPS + 1):
        keyed = words.mapInArrow(_keyed(letter_groups(letters, groups), groups), "word string, n long, size int, key long")
        sizes = keyed.groupBy("size", "key").agg(F.count("*").alias("c"))
        share = sizes.agg(F.sum(F.col("c") * F.col("c")) / F.sum("c")).first()[0] or 0
        if share <= tile:
            break
    cuts = sizes.select("size", "key", F.ceil(F.col("c") / tile).alias("cuts")).filter("cuts > 1")
    cut = keyed.join(cuts, ["size", "key"], "left")
    return cut.withColumn("tile", F.pmod(F.xxhash64("word"), F.coalesce("cuts", F.lit(1))).cast("int")).drop("cuts"), groups


_TILE_DDL = "size int, key long, tile int, data binary"


def _pack(table: pa.Table) -> pa.Table:
    held = table.select(["word", "n"])
    return table.select(["size", "key", "tile"]).slice(0, 1).append_column("data", pa.array([exchange.to_bytes(held)], pa.binary()))


def _neighbours(groups: int):
    """Each tile for each block that it meets: its own, those with one letter moved, those with one letter more.

    Of two blocks of one length only one is sent to the other.
    """
    steps = _steps(groups)
    pair = np.array(list(combinations(range(groups), 2))).reshape(-1, 2)
    moved = steps[pair[:, 1]] - steps[pair[:, 0]]
    change = np.concatenate([np.zeros(1, _U), moved, steps])
    longer = np.concatenate([np.zeros(1 + len(moved), np.int32), np.ones(groups, np.int32)])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, key, tile in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                to = (_U(key % (1 << 64)) + change).view(np.int64)
                count = len(to)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(size + longer, pa.int32()), pa.array(to), pa.array(np.full(count, size, np.int32)),
                        pa.array(np.full(count, key, np.int64)), pa.array(np.full(count, tile, np.int32)),
                    ],
                    ["size", "key", "own_size", "own_key", "own_tile"],
                )

    return each


# ---- pairs ----


class Block:
    """Words of one length as a matrix of letters, with their letter counts."""

    def __init__(self, table: pa.Table):
        self.words, self.n = table.column("word").combine_chunks(), table.column("n").to_numpy()
        letters, first = _latin(self.words)
        self.letters = letters.reshape(len(self.n), -1)
        length = self.letters.shape[1]
        kind = np.float32 if length < 2000 else np.float64
        flat = np.repeat(np.arange(len(self.n)), length) * _SYMBOLS + _SYMBOL[letters]
        self.counts = np.bincount(flat, minlength=len(self.n) * _SYMBOLS).reshape(-1, _SYMBOLS).astype(kind)
        self.square = (self.counts * self.counts).sum(axis=1)


def squared_distances(one: Block, two: Block) -> np.ndarray:
    """Of the letter counts of all pairs, by one product."""
    used = one.counts.any(axis=0) & two.counts.any(axis=0)
    left = np.column_stack([-2 * one.counts[:, used], one.square, np.ones_like(one.square)])
    right = np.column_stack([two.counts[:, used], np.ones_like(two.square), two.square])
    return left @ right.T


def one_edit(one: Block, two: Block, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a of ``one`` and b of ``two``, of the same length or one letter longer, are one edit apart."""
    x, y = one.letters[a], two.letters[b]
    if x.shape[1] == y.shape[1]:
        return (x != y).sum(axis=1) == 1
    ahead, behind = x != y[:, :-1], x != y[:, 1:]
    # all letters before some place agree, all from there on agree one place further
    first = np.where(ahead.any(axis=1), ahead.argmax(axis=1), x.shape[1])
    last = np.where(behind.any(axis=1), x.shape[1] - behind[:, ::-1].argmax(axis=1), 0)
    return first >= last


def near_pairs(one: Block, two: Block, same: bool, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Words of two blocks that are one edit apart; of a block with itself each pair once."""
    close = squared_distances(one, two) <= 2
    if same:
        close &= np.tri(len(one.n), k=-1, dtype=bool).T
    a, b = np.nonzero(close)
    each = max(1, most // max(1, two.letters.shape[1]))
    keep = [one_edit(one, two, a[k : k + each], b[k : k + each]) for k in range(0, len(a), each)]
    keep = np.concatenate(keep) if keep else np.zeros(0, bool)
    return a[keep], b[keep]


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])


def _best(words: pa.Array, near: pa.Array, near_n: np.ndarray) -> pa.RecordBatch:
    """One row a word: how many near words it has here, and the most frequent of them, ties to the smallest."""
    table = pa.table({"word": words, "near": near, "near_n": near_n}).sort_by([("word", "ascending"), ("near_n", "descending"), ("near", "ascending")])
    code = table.column("word").combine_chunks().dictionary_encode().indices.to_numpy()
    new = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    top = table.take(pa.array(new))
    n = np.diff(np.append(new, len(code)))
    return pa.RecordBatch.from_arrays(
        [top.column("word").combine_chunks(), pa.array(n), top.column("near_n").combine_chunks(), top.column("near").combine_chunks()], schema=_NEAR
    )


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for mine, theirs, same in zip(batch.column("asked"), batch.column("data"), batch.column("same").to_pylist(), strict=True):
            one, two = (Block(exchange.from_bytes(x.as_buffer())) for x in (mine, theirs))
            a, b = near_pairs(one, two, same)
            if len(a):
                left, right = one.words.take(pa.array(a)), two.words.take(pa.array(b))
                yield _best(pa.concat_arrays([left, right]), pa.concat_arrays([right, left]), np.append(two.n[b], one.n[a]))


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """word, n_near, best (count and word of the most frequent near word), for words that have one."""
    cut, groups = blocked(words, tile)
    tiles = exchange.written(cut.groupBy("size", "key", "tile").applyInArrow(_pack, _TILE_DDL))
    names = tiles.select("size", "key", "tile")
    block = (F.col("size") == F.col("own_size")) & (F.col("key") == F.col("own_key"))
    cells = exchange.written(
        names.mapInArrow(_neighbours(groups), "size int, key long, own_size int, own_key long, own_tile int")
        .join(names, ["size", "key"]).filter(~block | (F.col("own_tile") <= F.col("tile")))
        .withColumn("same", block & (F.col("own_tile") == F.col("tile")))
    )
    # the work of a cell does not show in its bytes, so tasks are dealt out by the number of cells
    tasks = max(16, cells.count() // TASK_CELLS)
    own = tiles.select(F.col("size").alias("own_size"), F.col("key").alias("own_key"), F.col("tile").alias("own_tile"), F.col("data").alias("asked"))
    asked = cells.join(own, ["own_size", "own_key", "own_tile"])
    cells = asked.repartition(tasks, "size", "key", "tile").join(tiles.repartition(tasks, "size", "key", "tile"), ["size", "key", "tile"])
    found = cells.select("asked", "data", "same").mapInArrow(_meet, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of at least 6 code points with at least 5 occurrences.

    Words are the maximal runs of A-Z, a-z and U+00C0-U+00FF of the whole texts, A-Z lower-cased; where 199 divides
    the crc32 of ``<id>:<word>``, the letter at that checksum modulo the length is taken out. Two words are near if
    they differ by one inserted, deleted or replaced letter. ``form`` is the near word of largest n (ties: the
    smallest), if it is at least 5 times as frequent, ``root`` the last one that forms lead to, the word itself if
    there is none. A null text has no words; in a row with a null id no letter is taken out; repeated rows count as
    often as they are there; an empty table gives no rows. Other columns are not read.
    """
    words = vocabulary(docs, id_col, text_col)
    near = near_words(words, tile)
    held = words.join(near, "word", "left")
    form_n = -F.col("best.less")
    held = exchange.written(held.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(form_n >= TIMES * F.col("n"), F.col("best.near")).alias("form"),
        F.when(form_n >= TIMES * F.col("n"), form_n).alias("form_n"),
    ))
    # a form is TIMES as frequent as its word, so chains are short; every round doubles the steps taken
    ends = exchange.written(held.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = exchange.written(
            ends.join(ends.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
            .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        )
        ends = further.select("word", "root")
        if further.filter("moved").isEmpty():
            break
    return held.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
