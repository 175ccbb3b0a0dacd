"""Encoding and decoding with the BPE model of a sentencepiece file, by vectorised merge rounds.

The texts of a batch are cut before spaces into units, each distinct unit is encoded once. All units lie behind each
other in flat arrays: symbol, unit, rank of the pair with the next symbol. A round finds the smallest rank of each unit
(segmented minimum), merges its occurrences from the left, all at once, and compacts the arrays; a unit without a pair
leaves. Where a merged piece could make a pair of a smaller rank, only its leftmost occurrence is merged in a round, so
that the order of merges is that of the sequential algorithm.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from editsieve.llm.exchange import arrow_schema, extended
from editsieve.llm.words import Words, bytes_of

SPACE = "▁"
BATCH_BYTES = 8 << 20
LONG_UNIT = 200
_NONE = np.int32(2**31 - 1)


class PieceModel:
    """Vocabulary of a BPE model file with identity normalisation, dummy prefix and byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rule = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.add_dummy_prefix:
            raise ValueError("the model must be BPE with identity normalisation and a dummy prefix")
        kinds = [p.type for p in model.pieces]
        self.size = len(kinds)
        plain = {p.piece: k for k, p in enumerate(model.pieces) if p.type == 1}
        score = {p.piece: p.score for p in model.pieces if p.type == 1}
        self.byte = np.array([k for k in range(self.size) if kinds[k] == 6], np.int32)
        if len(self.byte) != 256:
            raise ValueError("the model must have byte fallback")
        self.space_ids = {len(p): k for p, k in plain.items() if set(p) == {SPACE}}
        self.symbol = np.arange(self.size, self.size + 0x110000, dtype=np.int32)  # a character that is no piece
        for piece, k in plain.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = k
        merges, early = {}, set()
        for piece, k in plain.items():
            if len(piece) > 1 and set(piece) == {SPACE}:
                continue  # runs of spaces are looked up
            for cut in range(1, len(piece)):
                a, b = piece[:cut], piece[cut:]
                if a in plain and b in plain:
                    merges[plain[a], plain[b]] = k
                    early.update(plain[x] for x in (a, b) if len(x) > 1 and score[x] <= score[piece])
        by_score = sorted(plain.values(), key=lambda k: -model.pieces[k].score)
        self.rank = np.full(self.size, _NONE, np.int32)
        self.rank[by_score] = np.arange(len(by_score), dtype=np.int32)
        self.of_rank = np.array(by_score, np.int32)
        keys = np.array([a * self.size + b for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.pair_key, self.pair_rank = keys[order], self.rank[np.array(list(merges.values()))[order]]
        self.early = np.zeros(self.size, bool)
        self.early[list(early)] = True
        text = [
            b"" if kinds[k] == 3 else bytes([int(p.piece[3:5], 16)]) if kinds[k] == 6
            else model.trainer_spec.unk_surface.encode() if kinds[k] == 2 else p.piece.replace(SPACE, " ").encode()
            for k, p in enumerate(model.pieces)
        ]
        self.surface = np.frombuffer(b"".join(text), np.uint8)
        self.surface_end = np.cumsum([len(t) for t in text])
        self.surface_size = np.array([len(t) for t in text])
        self.unknown = kinds.index(2)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.pair_key, key).clip(max=len(self.pair_key) - 1)
        known = (self.pair_key[at] == key) & (left < self.size) & (right < self.size)
        return np.where(known, self.pair_rank[at], _NONE)

    # ---- encoding ----

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind each other, and where each text begins (one more than texts)."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        texts = pc.replace_substring(texts, SPACE, " ")
        prefix = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ").cast(pa.large_string())
        data, offsets = bytes_of(pc.binary_join_element_wise(prefix, texts, pa.scalar("", pa.large_string())))
        units = _units(data, offsets)
        hashes = units.hashes()
        _, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        ids, ends = self._encode_units(data, units.start[at], units.end[at])
        sizes = np.diff(ends, prepend=0)
        out = _ragged(ids, (ends - sizes)[inverse], sizes[inverse])
        total = np.zeros(len(inverse) + 1, np.int64)
        np.cumsum(sizes[inverse], out=total[1:])
        return out, total[units.first]

    def _encode_units(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units (spaces, then other characters) and where each unit ends."""
        count = len(start)
        size = end - start
        flat = _ragged(data, start, size)
        unit = np.repeat(np.arange(count), size)
        space = flat == 0x20
        spaces = np.bincount(unit[space], minlength=count)
        # one space stays with the characters behind it, the others are a run of their own
        word = spaces < size
        lead = spaces - (word & (spaces > 0))
        skip = np.repeat(np.cumsum(size) - size + lead, size)
        flat, unit = flat[np.arange(len(flat)) >= skip], unit[np.arange(len(unit)) >= skip]
        chars = np.frombuffer(flat.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        unit = unit[(flat & 0xC0) != 0x80]
        chars = np.where(chars == 0x20, ord(SPACE), chars)
        symbol, unit = self._merge(self.symbol[chars], unit)
        # a space that found no partner joins the run before it
        first = np.ones(len(unit), bool)
        first[1:] = unit[1:] != unit[:-1]
        bare = first & (symbol == self.space_ids[1])
        lead[unit[bare]] += 1
        symbol, unit = symbol[~bare], unit[~bare]
        symbol, unit = self._fall_back(symbol, unit)
        at = np.flatnonzero(lead)
        if len(at):
            run_ids = [self._spaces(int(n)) for n in lead[at]]
            symbol = np.concatenate([*run_ids, symbol]).astype(np.int32)
            unit = np.concatenate([np.repeat(at, [len(r) for r in run_ids]), unit])
            order = np.argsort(unit, kind="stable")
            symbol, unit = symbol[order], unit[order]
        return symbol, np.cumsum(np.bincount(unit, minlength=count))

    def _spaces(self, count: int) -> np.ndarray:
        """A run of spaces: all its pieces have one rank, so the leftmost pair grows first."""
        longest = max(self.space_ids)
        whole, rest = divmod(count, longest)
        return np.array([self.space_ids[longest]] * whole + self._space_rest(rest), np.int32)

    def _space_rest(self, count: int) -> list[int]:
        held = [1] * count
        while True:
            for k in range(len(held) - 1):
                if held[k] + held[k + 1] in self.space_ids:
                    held[k : k + 2] = [held[k] + held[k + 1]]
                    break
            else:
                return [self.space_ids[n] for n in held]

    def _merge(self, symbol: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done: list[tuple[np.ndarray, np.ndarray]] = []
        if len(unit):
            long = np.bincount(unit) > LONG_UNIT
            for k in np.flatnonzero(long):
                merged = self._merge_one(symbol[unit == k])
                done.append((merged, np.full(len(merged), k)))
            symbol, unit = symbol[~long[unit]], unit[~long[unit]]
        rank = np.full(len(symbol), _NONE, np.int32)
        same = np.flatnonzero(unit[1:] == unit[:-1])
        rank[same] = self.ranks(symbol[same], symbol[same + 1])
        while len(symbol):
            begin = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            size = np.diff(np.append(begin, len(unit)))
            least = np.minimum.reduceat(rank, begin)
            active = np.repeat(least < _NONE, size)
            if not active.all():
                done.append((symbol[~active], unit[~active]))
                symbol, unit, rank = symbol[active], unit[active], rank[active]
                size, least = size[least < _NONE], least[least < _NONE]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(least, size))
            # of overlapping pairs every other one from the left
            run = np.append(True, np.diff(at) > 1)
            place = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            first = np.append(True, unit[at][1:] != unit[at][:-1])
            new = self.of_rank[rank[at]]
            take = (place % 2 == 0) & (first | ~self.early[new])
            at, new = at[take], new[take]
            symbol[at] = new
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            at = moved[at]
            symbol, unit, rank = symbol[stay], unit[stay], rank[stay]
            for k in (at, at[at > 0] - 1):
                follows = k + 1 < len(symbol)
                rank[k[~follows]] = _NONE
                k = k[follows]
                rank[k] = np.where(unit[k] == unit[k + 1], self.ranks(symbol[k], symbol[k + 1]), _NONE)
        if not done:
            return symbol, unit
        symbol, unit = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(unit, kind="stable")
        return symbol[order], unit[order]

    def _merge_one(self, symbol: np.ndarray) -> np.ndarray:
        """One long unit with a heap of pairs: rank, then place."""
        held = symbol.tolist()
        after, before = list(range(1, len(held) + 1)), list(range(-1, len(held) - 1))
        rank = self.ranks(symbol[:-1], symbol[1:])
        heap = [(r, k) for k, r in enumerate(rank.tolist()) if r < _NONE]
        heapq.heapify(heap)
        table = self._table()
        while heap:
            r, k = heapq.heappop(heap)
            other = after[k]
            if held[k] is None or other >= len(held) or table.get(held[k] * self.size + held[other]) != r:
                continue
            held[k], held[other] = int(self.of_rank[r]), None
            after[k] = after[other]
            if after[k] < len(held):
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < len(held) and held[a] < self.size and held[b] < self.size:
                    found = table.get(held[a] * self.size + held[b])
                    if found is not None:
                        heapq.heappush(heap, (found, a))
        return np.array([x for x in held if x is not None], np.int32)

    @lru_cache(maxsize=1)  # noqa: B019  one model per process
    def _table(self) -> dict[int, int]:
        return dict(zip(self.pair_key.tolist(), self.pair_rank.tolist(), strict=True))

    def _fall_back(self, symbol: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become the pieces of their bytes."""
        odd = symbol >= self.size
        if not odd.any():
            return symbol, unit
        coded = [chr(c - self.size).encode() for c in symbol[odd].tolist()]
        size = np.ones(len(symbol), np.int64)
        size[odd] = [len(c) for c in coded]
        out = np.repeat(symbol, size)
        out[np.repeat(odd, size)] = self.byte[np.frombuffer(b"".join(coded), np.uint8)]
        return out, np.repeat(unit, size)

    # ---- decoding ----

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[str]:
        """Texts of id sequences that lie behind each other; bytes that are no UTF-8 become U+FFFD each."""
        if len(ids) and not (0 <= ids.min() and ids.max() < self.size):
            raise ValueError("id out of range")
        size = self.surface_size[ids]
        flat = _ragged(self.surface, self.surface_end[ids] - size, size).tobytes()
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        texts = []
        starts = ids[np.minimum(first[:-1], max(0, len(ids) - 1))] if len(ids) else np.zeros(len(first) - 1, int)
        for a, b, id_ in zip(ends[first[:-1]].tolist(), ends[first[1:]].tolist(), starts.tolist(), strict=True):
            text = flat[a + (b > a and flat[a] == 0x20 and id_ != self.unknown) : b]  # without the dummy prefix
            try:
                texts.append(text.decode("utf-8"))
            except UnicodeDecodeError:
                texts.append(_each_byte(text))
        return texts


def _each_byte(text: bytes) -> str:
    out, at = [], 0
    while at < len(text):
        for size in (1, 2, 3, 4):
            try:
                out.append(text[at : at + size].decode("utf-8"))
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


def _ragged(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Slices of ``data`` behind each other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.repeat(start - (ends - size), size) + np.arange(total)]


def _units(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Cuts before each run of spaces, and at the end of each row."""
    space = data == 0x20
    begin = np.zeros(len(data), bool)
    begin[1:] = space[1:] & ~space[:-1]
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(begin)
    end = np.append(start[1:], len(data))[: len(start)]
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, end, row, first)


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def slices(column: pa.Array, most: int = BATCH_BYTES) -> Iterator[slice]:
    """Consecutive rows of about ``most`` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(column):
        base = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield slice(at, upto)
        at = upto


def encode_texts(docs: DataFrame, path: str, text_col: str = "text", decoded: bool = True) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and, if asked for, ``decoded``, the text that these ids stand for.

    Whole texts; a null text is empty, an empty text has no ids. Columns of these names are replaced, others kept.
    """
    docs = docs.drop("ids", "decoded")
    schema = extended(docs.schema, "ids array<int>" + ", decoded string" * decoded)
    kept = docs.columns

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, arrow = piece_model(path), arrow_schema(schema)
        for batch in batches:
            for rows in slices(batch.column(text_col)):
                part = batch.slice(rows.start, rows.stop - rows.start)
                ids, first = model.encode(part.column(text_col))
                columns = [part.column(name) for name in kept]
                columns.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32())))
                if decoded:
                    columns.append(pa.array(model.decode(ids, first), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=arrow.names).cast(arrow)

    return docs.mapInArrow(each, schema)


def decode_ids(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the text of an array of ids. A null array is empty; null ids are left out."""
    rows = rows.drop("decoded")
    schema = extended(rows.schema, "decoded string")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            lists = batch.column(ids_col).to_pylist()
            held = [[x for x in ids or [] if x is not None] for ids in lists]
            first = np.cumsum([0, *map(len, held)])
            flat = np.array([x for ids in held for x in ids], np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.decode(flat, first), pa.string())], schema=arrow_schema(schema)
            )

    return rows.mapInArrow(each, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """n_tokens, and SHA-256 of the ids in decimal joined by commas and of the decoded text."""
    return encoded.withColumns({
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256),
        "decoded_sha256": F.sha2("decoded", 256),
    })
