"""Packing of documents into sequences of a fixed number of tokens, as a cutting-stock problem.

Each document is cut into full sequences and one remainder. Piece lengths fall into classes of ``grain`` tokens; the
histogram of classes is the demand of a linear program over patterns (how many pieces of each class share a sequence).
Patterns are generated as columns: the duals of the program price the classes, and a knapsack by dynamic programming
gives the pattern of largest price, until no pattern is worth more than one sequence. Patterns are rounded down, the
bounded rest is placed largest first, and pieces take the slots of their class in the order of their rank.

The driver holds the histogram (``length / grain`` numbers) and the patterns, whose number depends on that alone.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from editsieve.llm.exchange import arrow_schema, extended
from editsieve.session import cut_lineage

LENGTH = 2048
GRAIN = 4
END_ID = 1
MAX_COLUMNS = 4000
ROWS_PER_SALT = 2000
_SLICE_BYTES = 2 << 20

# The word pattern of the vocabulary, and the largest character up to which two libraries agree on it.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_LIMIT = "ɏ"


class Encoder:
    """Ids of a byte-level BPE vocabulary file, without special tokens added.

    Texts of Latin characters go through the faster of two libraries with the same merges; any other text, and one
    that holds the literal of a special token, goes through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import re

        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = [token["content"] for token in spec.get("added_tokens", [])]
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): number
            for token, number in spec["model"]["vocab"].items() if token not in added
        }
        self.plain = tiktoken.Encoding("plain", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.odd = re.compile("|".join([f"[^\x00-{PLAIN_LIMIT}]", *map(re.escape, added)]))

    def ids(self, text: str) -> np.ndarray:
        if self.odd.search(text):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.plain.encode_to_numpy(text, disallowed_special=())


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Full sequences and the remainder of each document, with the CRC-32 of their ids.

    A null text is empty: one token, the end. Rows of equal id are cut each for itself.
    """
    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    schema = arrow_schema(ddl)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        for batch in batches:
            rows = []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                for at in range(0, len(ids), length):
                    piece = ids[at : at + length]
                    rows.append((number, at, len(piece), zlib.crc32(piece.data), len(ids)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5, schema=schema
            )

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(each, ddl)


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, grain: int = GRAIN
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document (its tokens, then ``END_ID``) lies in one piece; pieces of a sequence follow each
    other from offset 0; sequences are at most ``length`` long. A null id is carried along. An empty table gives an
    empty result.
    """
    cut = cut_lineage(pieces(docs, vocabulary, id_col, text_col, length))
    kind = F.ceil(F.col("length") / grain).cast("int")
    units = -(-length // grain)
    demand = np.zeros(units + 1, np.int64)
    for row in cut.groupBy(kind.alias("kind")).count().collect():
        demand[row["kind"]] = row["count"]
    slots = Slots(patterns(demand, units), units)
    ranked = ranks(cut.withColumn("_kind", kind), int(demand.sum()))
    ddl = extended(cut.schema, "sequence_id long, _slot long")
    kept = cut.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, slot = slots.place(batch.column("_kind").to_numpy(), batch.column("_rank").to_numpy())
            held = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays([*held, pa.array(sequence), pa.array(slot)], schema=arrow_schema(ddl))

    before = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranked.mapInArrow(assign, ddl)
        .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
        .drop("_slot")
    )


def ranks(rows: DataFrame, count: int) -> DataFrame:
    """``_rank`` from 0 within each ``_kind``; a frequent kind is numbered in many salted groups with an offset each."""
    salts = max(1, -(-count // ROWS_PER_SALT))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)))
    group = ["_kind", "_salt"]
    sizes = salted.groupBy(*group).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_kind").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group).orderBy("doc_id", "start", "ids_crc32")
    numbered = salted.withColumn("_at", F.row_number().over(inside) - 1)
    return numbered.join(sizes, group).withColumn("_rank", F.col("_before") + F.col("_at")).drop("_salt", "_before", "_at")


class Slots:
    """Where the piece of a class with a rank goes: sequence and place in it."""

    def __init__(self, found: list[tuple[np.ndarray, int]], units: int):
        self.first: list[list[int]] = [[0] for _ in range(units + 1)]  # rank of the first piece of each run of slots
        self.runs: list[list[tuple[int, int, int]]] = [[] for _ in range(units + 1)]  # sequence, per sequence, place
        sequence = 0
        for pattern, times in found:
            place = 0
            for kind in np.flatnonzero(pattern)[::-1]:
                each = int(pattern[kind])
                self.first[kind].append(self.first[kind][-1] + each * times)
                self.runs[kind].append((sequence, each, place))
                place += each
            sequence += times

    def place(self, kind: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, slot = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
        for k in np.unique(kind):
            at = np.flatnonzero(kind == k)
            first, run = np.array(self.first[k]), np.array(self.runs[k])
            which = np.searchsorted(first, rank[at], "right") - 1
            base, each, place = run[which].T
            inside = rank[at] - first[which]
            sequence[at], slot[at] = base + inside // each, place + inside % each
        return sequence, slot


def patterns(demand: np.ndarray, units: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used; together they hold exactly ``demand[k]`` pieces of ``k`` units."""
    left = demand.copy()
    used: list[tuple[np.ndarray, int]] = []
    if left[units]:  # a full sequence has no room for anything else
        full = np.zeros(units + 1, np.int64)
        full[units] = 1
        used.append((full, int(left[units])))
        left[units] = 0
    kinds = np.flatnonzero(left)
    if len(kinds):
        columns, amounts = solve(kinds, left[kinds].astype(float), units)
        for column, amount in sorted(zip(columns, amounts, strict=True), key=lambda x: -x[1]):
            has = np.flatnonzero(column)
            times = int(min(np.floor(amount + 1e-9), (left[kinds[has]] // column[has]).min())) if len(has) else 0
            if times > 0:
                pattern = np.zeros(units + 1, np.int64)
                pattern[kinds] = column
                used.append((pattern, times))
                left -= pattern * times
    return used + largest_first(left, units)


def solve(kinds: np.ndarray, demand: np.ndarray, units: int, gap: float = 1e-4) -> tuple[list[np.ndarray], np.ndarray]:
    """The linear program by column generation: columns of the basis and their amounts.

    Ends when the bound from the duals proves the value to be within ``gap``, at the latest after ``MAX_COLUMNS``.
    """
    size = len(kinds)
    basis = [np.where(np.arange(size) == k, units // kinds[k], 0) for k in range(size)]
    cost = np.ones(size)
    inverse = np.diag(1.0 / np.array([units // k for k in kinds]))
    amounts = inverse @ demand
    for _ in range(MAX_COLUMNS):
        duals = cost @ inverse
        if duals.min() < -1e-9:  # more of a class than asked for is worth nothing
            column, price = np.zeros(size), 0.0
            column[int(duals.argmin())] = -1
        else:
            column = knapsack(kinds, duals, units)
            price = 1.0
            worth = float(duals @ column)
            if worth <= 1 + 1e-9 or duals @ demand / worth >= (1 - gap) * amounts[cost > 0].sum():
                break
        step = inverse @ column
        up = step > 1e-9
        if not up.any():
            break
        ratio = np.where(up, amounts / np.where(up, step, 1), np.inf)
        out = int(ratio.argmin())
        inverse[out] /= step[out]
        amounts[out] /= step[out]
        for_others = step.copy()
        for_others[out] = 0
        inverse -= np.outer(for_others, inverse[out])
        amounts = np.maximum(amounts - for_others * amounts[out], 0)
        basis[out], cost[out] = column, price
    real = [k for k in range(size) if cost[k] > 0]
    return [np.asarray(basis[k], np.int64) for k in real], amounts[real]


def knapsack(kinds: np.ndarray, worth: np.ndarray, units: int) -> np.ndarray:
    """Amounts of each class of largest total worth within ``units``."""
    best, take = np.zeros(units + 1), np.full(units + 1, -1)
    fits = np.searchsorted(kinds, np.arange(units + 1), "right")
    for room in range(1, units + 1):
        best[room] = best[room - 1]
        n = fits[room]
        if n:
            value = worth[:n] + best[room - kinds[:n]]
            k = int(value.argmax())
            if value[k] > best[room] + 1e-12:
                best[room], take[room] = value[k], k
    column, room = np.zeros(len(kinds)), units
    while room > 0:
        if take[room] < 0:
            room -= 1
        else:
            column[take[room]] += 1
            room -= kinds[take[room]]
    return column


def largest_first(left: np.ndarray, units: int) -> list[tuple[np.ndarray, int]]:
    """The rest: each sequence takes the largest class that still fits, again and again."""
    left = left.copy()
    used = []
    while left.any():
        pattern, room = np.zeros(units + 1, np.int64), units
        while room and (some := np.flatnonzero(left[: room + 1] - pattern[: room + 1])).size:
            kind = some[-1]
            n = min(room // kind, left[kind] - pattern[kind])
            pattern[kind] += n
            room -= kind * n
        has = pattern > 0
        times = int((left[has] // pattern[has]).min())
        used.append((pattern, times))
        left -= pattern * times
    return used
