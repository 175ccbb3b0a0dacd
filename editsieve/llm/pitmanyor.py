"""A hierarchical Pitman-Yor language model of word pairs: every context word is a restaurant, all share one parent.

Customers of a restaurant are the words that follow its context in the training texts; each of its tables is a
customer of the parent. Seatings are sampled by Gibbs sweeps in which all customers of one dish leave their restaurant
and are seated again one after another. Predictive probabilities are averaged over the last sweeps.

The corpus is spread by context: a part of the key space holds whole restaurants, so their seating needs no
communication. Each part samples with the parent that its own restaurants form; the parents are then merged over the
parts and seated once more. A context too frequent for one part is spread over all parts by the word that follows. The
number of such contexts is bounded. What a chunk of documents needs for its scores comes back as an answer.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from editsieve.llm import exchange
from editsieve.llm.words import mix, split_words

DISCOUNT, STRENGTH = 0.8, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.7, 1.0
BURN_IN, SAMPLES = 2, 3
ONE_BY_ONE = 64  # customers of a dish that are seated singly; later ones in groups of a sixteenth of those seated
HEAVY_FROM = 1 << 18  # occurrences from which on a context is spread over the parts
HEAVY_MOST = 1 << 16  # and at least this share of all tokens, so that there are no more such contexts than this
CHUNK_BYTES = 12 << 20
FOLDS, HELD_OUT = 7, 2
_U = np.uint64
_BEGIN, _END = _U(0x243F6A8885A308D3), _U(0x13198A2E03707344)
_CODES, _ZERO = 2500.0, 5_000  # a count is answered as its logarithm in steps of 1 / 2500; ``_ZERO`` stands for 1
_FAR = 65_535  # code of a count beyond the codes (some 3e10), which is answered in full
_SHIFT = _U(24)  # followers are named by 40 bits of their hash


# ---- seating ----


def seat(count: np.ndarray, strength: np.ndarray, parent: np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its ``count`` customers were seated; ``strength`` is that of the restaurant without them."""
    order = np.argsort(-count, kind="stable")
    count, strength, parent = count[order], strength[order], parent[order]
    tables = np.ones(len(count))
    seated = 1
    while len(count) and count[0] > seated:
        n = int(np.searchsorted(-count, -seated, "left"))  # dishes with more customers than that
        group = 1 if seated < ONE_BY_ONE else seated // 16
        new = (strength[:n] + discount * tables[:n]) * parent[:n]
        p = new / (new + seated - discount * tables[:n])
        size = np.minimum(group, count[:n] - seated).astype(np.int64)
        tables[:n] += random.random(n) < p if group == 1 else random.binomial(size, p)
        seated += group
    out = np.empty(len(count))
    out[order] = np.minimum(tables, count)
    return out


@dataclass
class Seating:
    tables: np.ndarray  # of each (context, word), in the last sweep
    mean_tables: np.ndarray  # averaged over the samples
    mean_total: np.ndarray  # tables of each context, averaged


def gibbs(context: np.ndarray, word: np.ndarray, count: np.ndarray, spread: np.ndarray, words: int, seed: int) -> Seating:
    """Sweeps over the restaurants of a part. ``spread``: by how much a context is larger than what is here."""
    random = np.random.default_rng(seed)
    tables = np.ones(len(count))
    contexts = len(spread)
    many = np.flatnonzero(count > 1)
    sums, total = np.zeros(len(count)), np.zeros(contexts)
    for sweep in range(BURN_IN + SAMPLES):
        at_table = np.bincount(context, tables, contexts)
        guests = np.bincount(word, tables, words)
        root = seat(guests, np.full(words, ROOT_STRENGTH), np.full(words, 1 / (words + 1)), ROOT_DISCOUNT, random)
        room = ROOT_STRENGTH + guests.sum()
        fresh = (ROOT_STRENGTH + ROOT_DISCOUNT * root.sum()) / room / (words + 1)
        c, w, mine = context[many], word[many], tables[many]
        kept = (guests[w] - mine) * (1 - ROOT_DISCOUNT * root[w] / guests[w])
        strength = STRENGTH + DISCOUNT * (at_table[c] * spread[c] - mine)
        tables[many] = seat(count[many], strength, kept / room + fresh, DISCOUNT, random)
        if sweep >= BURN_IN:
            sums += tables
            total += np.bincount(context, tables, contexts)
    return Seating(tables, sums / SAMPLES, total / SAMPLES)


# ---- word pairs of a chunk ----


def held_out(number: int | None) -> bool:
    return zlib.crc32(b"" if number is None else str(number).encode()) % FOLDS == HELD_OUT


@dataclass
class Pairs:
    """Distinct (context, word) of a chunk, in the order in which they are sent; words are named by position."""

    names: np.ndarray  # sorted hashes of all words, of the begin and of the end
    context: np.ndarray
    word: np.ndarray
    count: np.ndarray  # in training texts
    part: np.ndarray
    heavy: np.ndarray  # whether the context of a pair is spread
    of_token: np.ndarray  # pair of each token
    row: np.ndarray
    train: np.ndarray  # rows


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)


def pairs_of(table: pa.Table, heavy: np.ndarray, parts: int) -> Pairs:
    words = split_words(table.column("text"))
    hashes, rows = words.hashes(lower=True), table.num_rows
    train = np.array([not held_out(i) for i in table.column("id").to_pylist()], bool)
    names, place = np.unique(np.concatenate([hashes, [_BEGIN, _END]]), return_inverse=True)
    tokens = len(hashes) + rows
    at = np.arange(len(hashes)) + words.row
    context, word = np.full(tokens, place[-2]), np.full(tokens, place[-1])
    word[at], context[at + 1] = place[:-2], place[:-2]
    row = np.repeat(np.arange(rows), np.diff(words.first) + 1)
    key, of_token = np.unique(context * len(names) + word, return_inverse=True)
    count = np.bincount(of_token, train[row], len(key)).astype(np.int64)
    context, word = key // len(names), key % len(names)
    spread = np.isin(names, heavy)[context]
    part = part_of(names, parts)[context]
    part[spread] = part_of(mix(names[context[spread]] ^ mix(names[word[spread]]), 9), parts)
    order = np.lexsort((spread, part))
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    return Pairs(names, context[order], word[order], count[order], part[order], spread[order], moved[of_token], row, train)


def message(names: np.ndarray, pairs: Pairs, a: int, b: int, lo: int, hi: int) -> bytes:
    """Owned words lo:hi with the sizes of their runs, then spread contexts with theirs, then the pairs a:b."""
    own = int(b - a - pairs.heavy[a:b].sum())
    runs = np.bincount(pairs.context[a : a + own] - lo, minlength=hi - lo)
    other, sizes = np.unique(pairs.context[a + own : b], return_counts=True)
    count, follower = pairs.count[a:b], names[pairs.word[a:b]] >> _SHIFT
    width = 1 if not len(count) or count.max() < 256 else 8
    return b"".join((
        np.array([hi - lo, len(other), b - a, width], np.uint32).tobytes(), names[lo:hi].tobytes(), runs.astype(np.uint32).tobytes(),
        names[other].tobytes(), sizes.astype(np.uint32).tobytes(), (follower >> _U(8)).astype(np.uint32).tobytes(),
        follower.astype(np.uint8).tobytes(), count.astype(f"u{width}").tobytes(),
    ))


class Read:
    """Arrays that lie behind each other in bytes."""

    def __init__(self, data):
        self.data, self.at = data, 0

    def __call__(self, kind, count: int) -> np.ndarray:
        out = np.frombuffer(self.data, kind, int(count), self.at)
        self.at += out.nbytes
        return out


def followers(read: Read, count: int) -> np.ndarray:
    high = read(np.uint32, count).astype(_U) << _U(8)
    return high | read(np.uint8, count)


# ---- parts ----


class Part:
    """The restaurants of a part, merged from the messages of all chunks and seated."""

    def __init__(self, number: int, sent: list, parts: int):
        self.owned, self.where, context, follower, count, spread = [], [], [], [], [], []
        for data in sent:
            read = Read(data)
            n, h, pairs, width = read(np.uint32, 4).tolist()
            own, runs = read(_U, n), read(np.uint32, n)
            other, sizes = read(_U, h), read(np.uint32, h)
            self.owned.append(own)
            self.where.append(pairs)
            context.append(np.concatenate([np.repeat(own, runs), np.repeat(other, sizes)]))
            spread.append(np.arange(pairs) >= runs.sum())
            follower.append(followers(read, pairs))
            count.append(read(f"u{width}", pairs).astype(np.int64))
        context, follower, count, spread = map(np.concatenate, (context, follower, count, spread))
        order = np.lexsort((follower, context))
        new = np.ones(len(order), bool)
        a, b = context[order], follower[order]
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.pair = np.empty(len(order), np.int64)  # of each pair that was sent
        self.pair[order] = np.cumsum(new) - 1
        self.count = np.bincount(self.pair, count, int(new.sum()))
        first = order[new]
        self.names, self.context = np.unique(context[first], return_inverse=True)
        self.spread = np.zeros(len(self.names), bool)
        self.spread[self.context] = spread[first]
        self.follower = follower[first]
        self.known = np.flatnonzero(self.count > 0)
        self.words, word = np.unique(self.follower[self.known], return_inverse=True)
        self.seating = gibbs(
            self.context[self.known], word, self.count[self.known], np.where(self.spread, parts, 1), len(self.words), number
        )
        self.guests = np.bincount(word, self.seating.tables, len(self.words))
        self.customers = np.bincount(self.context, self.count, len(self.names))


_ROOT = pa.schema([("part", pa.int32()), ("source", pa.int32()), ("types", pa.int64()), ("data", pa.binary())])
_ROOT_DDL = "part int, source int, types long, data binary"
_ROOTS = pa.schema([("part", pa.int32()), ("guests", pa.float64()), ("tables", pa.float64()), ("types", pa.int64()), ("data", pa.binary())])
_ROOTS_DDL = "part int, guests double, tables double, types long, data binary"


def _sorted_messages(table: pa.Table, by: str) -> tuple[pa.Table, list]:
    table = table.sort_by(by)
    return table, [memoryview(x.as_buffer()) for x in table.column("data")]


def _to_root(parts: int):
    """The tables of a part as guests of the parent, by the part that owns the word; sizes of spread contexts beside them."""

    def each(table: pa.Table) -> pa.Table:
        number = table.column("part")[0].as_py()
        part = Part(number, _sorted_messages(table, "chunk")[1], parts)
        real = (part.customers > 0) & ~part.spread & (part.names != _BEGIN)
        types = int(real.sum())
        spread = part.names[part.spread]
        owner = part_of(spread, parts)
        target = part_of(part.words << _SHIFT, parts)
        rows = {"part": [], "source": [], "types": [], "data": []}
        for p in np.union1d(target, owner).tolist():
            a, b = np.searchsorted(target, [p, p + 1])
            some = owner == p
            words, guests = part.words[a:b], part.guests[a:b]
            rows["data"].append(b"".join((
                np.array([b - a, some.sum()], np.uint32).tobytes(), (words >> _U(8)).astype(np.uint32).tobytes(), words.astype(np.uint8).tobytes(),
                guests.astype(np.uint32).tobytes(), spread[some].tobytes(), part.customers[part.spread][some].tobytes(),
                part.seating.mean_total[part.spread][some].tobytes(),
            )))
            rows["part"].append(p)
            rows["source"].append(number)
            rows["types"].append(0)
        if rows["types"]:
            rows["types"][0] = types
        return pa.Table.from_batches([exchange.rows_out(rows, _ROOT)])

    return each


def _root(parts: int):
    """The parent's share of a part: guests and tables of its words, and sizes of the spread contexts that it owns."""

    def each(table: pa.Table) -> pa.Table:
        number = table.column("part")[0].as_py()
        types = sum(table.column("types").to_pylist())
        words, guests, spread, sizes = [], [], [], []
        for data in _sorted_messages(table, "source")[1]:
            read = Read(data)
            n, h = read(np.uint32, 2).tolist()
            words.append(followers(read, n))
            guests.append(read(np.uint32, n))
            spread.append(read(_U, h))
            sizes.append(np.stack([read(np.float64, h), read(np.float64, h)]))
        words, at = np.unique(np.concatenate(words), return_inverse=True)
        guests = np.bincount(at, np.concatenate(guests), len(words))
        random = np.random.default_rng([number, 1])
        uniform = np.full(len(words), 1 / (parts * len(words) + 1))
        tables = sum(seat(guests, np.full(len(words), ROOT_STRENGTH), uniform, ROOT_DISCOUNT, random) for _ in range(SAMPLES)) / SAMPLES
        spread, at = np.unique(np.concatenate(spread), return_inverse=True)
        sizes = [np.bincount(at, x, len(spread)) for x in np.concatenate(sizes, axis=1)]
        data = b"".join((
            np.array([len(words), len(spread)], _U).tobytes(), words.tobytes(), guests.tobytes(), tables.tobytes(), spread.tobytes(), *[x.tobytes() for x in sizes]
        ))
        return pa.Table.from_batches([exchange.rows_out(
            {"part": [number], "guests": [guests.sum()], "tables": [tables.sum()], "types": [types], "data": [data]}, _ROOTS
        )])

    return each


def _answers(parts: int, heavy_types: int):
    """What each chunk needs: size, tables and parent probability of the words it named, and discounted counts of its pairs."""

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return exchange.SENT.empty_table()
        number = left.column("part")[0].as_py()
        left, sent = _sorted_messages(left, "chunk")
        part = Part(number, sent, parts)
        words = spread = np.zeros(0, _U)
        guests = tables = sizes = totals = np.zeros(0)
        all_guests = all_tables = 0.0
        types = heavy_types
        if right.num_rows:
            row = right.to_pylist()[0]
            read = Read(row["data"])
            n, h = read(_U, 2).tolist()
            words, guests, tables = read(_U, n), read(np.float64, n), read(np.float64, n)
            spread, sizes, totals = read(_U, h), read(np.float64, h), read(np.float64, h)
            all_guests, all_tables, types = row["all_guests"], row["all_tables"], row["all_types"] + heavy_types
        room = ROOT_STRENGTH + all_guests
        fresh = (ROOT_STRENGTH + ROOT_DISCOUNT * all_tables) / room / (types + 1)
        value = np.zeros(len(part.count))
        value[part.known] = part.count[part.known] - DISCOUNT * part.seating.mean_tables
        out, at = [], 0
        for own, pairs in zip(part.owned, part.where, strict=True):
            size, total = _look_up(part.names, own, part.customers, part.seating.mean_total)
            for names, a, b in ((spread, sizes, totals),):
                found = np.isin(own, names)
                size[found], total[found] = _look_up(names, own[found], a, b)
            r, k = _look_up(words, own >> _SHIFT, guests, tables)
            parent = (r - ROOT_DISCOUNT * k) / room + fresh
            out.append(b"".join((
                np.array([types, len(own)], np.float64).tobytes(), size.astype(_U).tobytes(), total.astype(np.float32).tobytes(),
                parent.astype(np.float32).tobytes(), coded(value[part.pair[at : at + pairs]]),
            )))
            at += pairs
        return pa.table([left.column("part"), left.column("chunk"), pa.array(out, pa.binary())], schema=exchange.SENT)

    return each


def coded(value: np.ndarray) -> bytes:
    """Discounted counts, 0 or at least 1 less the discount: two bytes each, then in full those that no code reaches."""
    code = np.zeros(len(value), np.uint16)
    some = value > 0
    code[some] = np.clip(np.rint(np.log(value[some]) * _CODES) + _ZERO, 1, _FAR)
    return code.tobytes() + value[code == _FAR].tobytes()


def decoded(read: Read, count: int) -> np.ndarray:
    code = read(np.uint16, count)
    value = np.where(code > 0, np.exp((code - float(_ZERO)) / _CODES), 0.0)
    far = code == _FAR
    value[far] = read(np.float64, far.sum())
    return value


def _look_up(names: np.ndarray, wanted: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Values of the sorted ``names`` for ``wanted``, 0 where there is none."""
    if not len(names):
        return [np.zeros(len(wanted)) for _ in values]
    at = np.searchsorted(names, wanted).clip(max=len(names) - 1)
    known = names[at] == wanted
    return [np.where(known, x[at], 0.0) for x in values]


# ---- the model over a table ----


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the lower-cased words (A-Z) and one end. Documents of the fold ``HELD_OUT`` of ``FOLDS`` (by the CRC-32
    of the id) are scored only; a null id counts as an empty text for that. ``base_score`` is the unigram model with
    one added, ``score`` the log10 probability by the model; 10 ** (-score / n_tokens) is the perplexity. Whole texts;
    a null text is empty and has the end only.
    """
    chunks = exchange.pack(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "text", CHUNK_BYTES)
    parts = exchange.parts_of(chunks)
    tokens, texts, heavy = _frequent(chunks)
    heavy_types = int((heavy != _BEGIN).sum()) + (texts > 0)

    def ask(table: pa.Table) -> Iterator[tuple[int, bytes]]:
        pairs = pairs_of(table, heavy, parts)
        edges = np.arange(parts + 1)
        ends, owned = np.searchsorted(pairs.part, edges), np.searchsorted(part_of(pairs.names, parts), edges)
        for p in np.flatnonzero((np.diff(ends) > 0) | (np.diff(owned) > 0)).tolist():
            yield p, message(pairs.names, pairs, ends[p], ends[p + 1], owned[p], owned[p + 1])

    sent = exchange.send(chunks, ask)
    roots = sent.groupBy("part").applyInArrow(_to_root(parts), _ROOT_DDL).groupBy("part").applyInArrow(_root(parts), _ROOTS_DDL)
    totals = roots.groupBy().agg(
        F.sum("guests").alias("all_guests"), F.sum("tables").alias("all_tables"), F.sum("types").alias("all_types")
    )
    roots = roots.withColumn("_all", F.lit(1)).join(totals.withColumn("_all", F.lit(1)), "_all").drop("_all")
    answers = sent.groupBy("part").cogroup(roots.groupBy("part")).applyInArrow(_answers(parts, heavy_types), exchange.SENT_DDL)

    def scores(_: int, table: pa.Table, got: list) -> pa.Table:
        pairs = pairs_of(table, heavy, parts)
        names = len(pairs.names)
        edges = np.arange(parts + 1)
        ends, owned = np.searchsorted(pairs.part, edges), np.searchsorted(part_of(pairs.names, parts), edges)
        size, total, parent = np.zeros(names), np.zeros(names), np.zeros(names)
        value, types = np.zeros(len(pairs.count)), 0.0
        for p, data in got:
            read = Read(data)
            types, n = read(np.float64, 2).tolist()
            own = slice(owned[p], owned[p + 1])
            size[own], total[own], parent[own] = read(_U, n), read(np.float32, n), read(np.float32, n)
            value[ends[p] : ends[p + 1]] = decoded(read, ends[p + 1] - ends[p])
        of = pairs.context
        chance = (value + (STRENGTH + DISCOUNT * total[of]) * parent[pairs.word]) / (STRENGTH + size[of])
        size[pairs.names == _END] = texts
        rows, token = table.num_rows, pairs.of_token
        n_tokens = np.bincount(pairs.row, minlength=rows)
        seen = size[pairs.word]
        base = np.bincount(pairs.row, np.log10(seen + 1)[token], rows) - n_tokens * math.log10(tokens + types + 1)
        return pa.table({
            id_col: table.column("id"), "held_out": pa.array(~pairs.train), "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(np.bincount(pairs.row, (seen > 0)[token], rows).astype(np.int64)),
            "train_tokens": pa.array(np.full(rows, tokens, np.int64)), "base_score": pa.array(base),
            "score": pa.array(np.bincount(pairs.row, np.log10(chance)[token], rows)),
        })

    return exchange.with_answers(
        chunks, answers, scores,
        f"`{id_col}` long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def _frequent(chunks: DataFrame) -> tuple[int, int, np.ndarray]:
    """Training tokens, training texts, and the contexts to be spread, at most about ``HEAVY_MOST``."""
    words = chunks.agg(F.sum("words")).first()[0] or 0
    limit = max(HEAVY_FROM, words // HEAVY_MOST)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data"):
                table = exchange.from_bytes(data.as_buffer())
                found = split_words(table.column("text"))
                train = np.array([not held_out(i) for i in table.column("id").to_pylist()], bool)
                hashes = found.hashes(lower=True)[train[found.row]]
                names, count = np.unique(hashes, return_counts=True)
                often = count >= max(1.0, limit * len(hashes) / max(1, words) / 2)
                name = np.concatenate([names[often], [_BEGIN, _U(0), _U(1)]]).view(np.int64)
                n = np.concatenate([count[often], [train.sum(), len(hashes) + train.sum(), train.sum()]])
                kind = np.concatenate([np.zeros(often.sum() + 1, np.int32), np.array([1, 2], np.int32)])
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(name), pa.array(n, pa.int64())], ["kind", "name", "n"])

    rows = (
        chunks.select("data").mapInArrow(each, "kind int, name long, n long").groupBy("kind", "name").agg(F.sum("n").alias("n"))
        .filter((F.col("kind") > 0) | (F.col("n") >= limit)).collect()
    )
    total = {r["kind"]: r["n"] for r in rows if r["kind"] > 0}
    heavy = np.array([r["name"] for r in rows if r["kind"] == 0], np.int64).view(_U)
    return total.get(1, 0), total.get(2, 0), np.sort(heavy)
