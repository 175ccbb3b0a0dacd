"""Similarity join of documents on word shingles by PartEnum signatures, down to classes of linked documents.

Sets that may link have nearly equal sizes and a small symmetric difference, so within a band of sizes the difference
has a fixed bound. The domain of hashed shingles is cut into groups of partitions; a signature is a set's content in
some partitions of one group, and enumerating the subsets of a group's partitions makes similar sets of a band share
one. Sets that share a signature are compared exactly. Work goes in three steps, each of which shuffles less:

1. documents with equal sets are one (grouped by a 128-bit fingerprint of the set);
2. of each signature, every set is compared with the first one that has it; that links groups of near copies in time
   linear in their size;
3. what shares a signature but is not in one class yet is compared with each other. Where the guarantee of PartEnum
   says that a pair must also share a signature that few sets have, frequent ones are left out; sets of frequent
   signatures alone are compared with a few hubs of their group, and what that leaves apart with the group in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from editsieve.llm import exchange
from editsieve.llm.components import components
from editsieve.llm.words import mix, release_memory, runs, split_words

SHINGLE = 5
PERCENT = 80
FREQUENT = 32  # sets that share a signature from which on it counts as frequent
SEEDS = 6
MASK_BYTES = 8 << 20
HUBS = 8
BLOCK = 256
SLICE_BYTES = 1 << 20  # of text that is worked on at once
_LAST = np.iinfo(np.int64).max
_U = np.uint64


# ---- shingle sets ----


@dataclass
class Sets:
    """Distinct shingles of each row, sorted within the row, behind each other."""

    shingle: np.ndarray
    first: np.ndarray  # one more than rows

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)


def shingle_sets(texts: pa.Array, length: int = SHINGLE) -> Sets:
    """A row of fewer words has its whole sequence as its only shingle; a row without words has none."""
    words = split_words(texts)
    hashes = words.hashes(lower=True)
    key, start = runs(hashes, words.row, length)
    row = words.row[start]
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < length))
    whole = np.zeros(len(short), _U)
    for k in range(length - 1):
        has = counts[short] > k
        whole[has] = whole[has] * _U(0xD1342543DE82EF95) + hashes[words.first[short[has]] + k]
    key = np.concatenate([key, mix(whole ^ mix(counts[short].astype(_U)), 3)])
    row = np.concatenate([row, short])
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    key, row = key[new], row[new]
    return Sets(key, np.searchsorted(row, np.arange(len(counts) + 1)))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def row_slices(texts: pa.ChunkedArray, rows: np.ndarray, most: int = SLICE_BYTES) -> Iterator[np.ndarray]:
    """``rows`` in runs of about ``most`` bytes of text, so that the arrays of a run stay small."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()[rows]
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(rows):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield rows[at:upto]
        at = upto


# ---- signatures ----


@dataclass(frozen=True)
class Plan:
    """PartEnum for sets of up to ``top`` shingles: ``groups`` of ``parts`` partitions, of which ``spare`` are left out."""

    top: int
    groups: int
    parts: int
    spare: int


def plan_of(top: int, percent: int = PERCENT) -> Plan:
    """More groups than can all differ too much, with some to spare for empty partitions and frequent signatures."""
    differ = 2 * top * (100 - percent) // (100 + percent)
    if differ == 0:
        return Plan(top, 1, 1, 0)
    if top <= 32:
        return Plan(top, differ // 2 + 1 + (top > 16), 4, 1)
    return Plan(top, -(-2 * top // 7), 1, 0)


def bands(size: int, percent: int = PERCENT) -> list[int]:
    """Upper sizes of the bands a set is in: its own, and the next if a larger set there may link with it."""
    top = 1 << (size - 1).bit_length() if size > 1 else 1
    return [top] if size * 100 // percent <= top else [top, 2 * top]


def signatures(sets: Sets, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signature, row, and slack of each: a pair that links shares signatures in at least ``slack`` groups of its band."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    sizes = sets.sizes
    values = mix(sets.shingle, 11)
    tops = np.zeros(len(sizes), np.int64)
    some = sizes > 0
    tops[some] = 1 << np.ceil(np.log2(sizes[some])).astype(np.int64)
    both = some & (sizes * 100 // percent > tops)
    for top in np.unique(np.concatenate([tops[some], 2 * tops[both]])):
        rows = np.flatnonzero(some & ((tops == top) | both & (2 * tops == top)))
        for seed in range(SEEDS):
            rows = _band(sets, values, rows, plan_of(int(top), percent), seed, percent, out)
            if not len(rows):
                break
    return tuple(np.concatenate(x) if x else np.zeros(0, d) for x, d in zip(zip(*out, strict=True) if out else ([], [], []), (_U, np.int64, np.int64), strict=True))


def _band(sets: Sets, values: np.ndarray, rows: np.ndarray, plan: Plan, seed: int, percent: int, out: list) -> np.ndarray:
    """Adds the signatures of ``rows``; gives the rows that may agree in empty partitions only and need another seed."""
    sizes = sets.sizes[rows]
    at = np.repeat(sets.first[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    cells = plan.groups * plan.parts
    domain = sets.shingle[at] if seed == 0 else mix(sets.shingle[at], 50 + seed)
    cell = ((domain >> _U(32)) * _U(cells) >> _U(32)).astype(np.int64)
    # content and number of shingles of each partition of each set
    flat = np.repeat(np.arange(len(rows)), sizes) * cells + cell
    order = np.argsort(flat, kind="stable")
    held, where = np.unique(flat[order], return_index=True)
    content = np.zeros(len(rows) * cells, _U)
    content[held] = np.add.reduceat(values[at][order], where) if len(where) else 0
    count = np.bincount(flat, minlength=len(rows) * cells)
    content = content.reshape(len(rows), plan.groups, plan.parts)
    count = count.reshape(len(rows), plan.groups, plan.parts)
    partner = np.minimum(plan.top, sizes * 100 // percent)
    differ = (sizes + partner) * (100 - percent) // (100 + percent)
    empty = np.zeros((len(rows), plan.groups), bool)
    found = []
    for number, chosen in enumerate(combinations(range(plan.parts), plan.parts - plan.spare)):
        none = count[:, :, chosen].sum(axis=2) == 0
        empty |= none
        with np.errstate(over="ignore"):
            tag = mix(np.arange(plan.groups, dtype=_U) * _U(64) + _U(number) + _U(plan.top << 24) + _U(seed << 60), 5)
            found.append((mix(content[:, :, chosen].sum(axis=2, dtype=_U) + tag[None, :], 6), none))
    slack = plan.groups - differ // (plan.spare + 1) - empty.sum(axis=1)
    last = seed == SEEDS - 1
    for signature, none in found:
        keep = ~none | (last & (slack < 1))[:, None]
        r, g = np.nonzero(keep)
        out.append((signature[r, g], rows[r], slack[r]))
    return rows[slack < 1]


# ---- the join ----


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, length: int = SHINGLE) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id``, the smallest id that links lead to, itself included.

    Words are lower-cased (A-Z). A document without words is linked with nothing. Rows of equal id count as one
    document if their texts have equal sets, else each goes its own way under its id. A null id counts as the
    largest and is its own class's id only if nothing else is in it (then null). Whole texts, all rows; no cap on the
    number of sets that share a signature.
    """
    _, rows = _classified(docs.select(id_col, text_col), id_col, text_col, percent, length)
    real = F.when(F.col("id") != _LAST, F.col("id"))
    least = F.coalesce("least", "id")
    return rows.select(real.alias(id_col), F.col("n_shingles"), F.when(least != _LAST, least).alias("component_id"))


def first_of_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, length: int = SHINGLE) -> DataFrame:
    """``docs`` without the rows that are linked, over any number of links, with another row that stays.

    Of each class the row of the smallest id stays, of equal ids one; a null id counts as the largest. Rows are told
    apart by their place, so rows of one id may be in different classes. Rows without words all stay.
    """
    chunks, rows = _classified(docs, id_col, text_col, percent, length)
    held = rows.filter("n_shingles > 0").groupBy("component").agg(F.min(F.struct("id", "chunk", "row")).alias("first"))
    held = held.select("first.chunk", "first.row").union(rows.filter("n_shingles = 0").select("chunk", "row"))

    def take(_: int, table: pa.Table, got: np.ndarray) -> Iterator[pa.Table]:
        for some in row_slices(table.column(text_col), got, 4 * SLICE_BYTES):
            yield table.take(pa.array(some))

    return _per_chunk(chunks, exchange.written(held), take, docs.schema)


def _classified(docs: DataFrame, id_col: str, text_col: str, percent: int, length: int) -> tuple[DataFrame, DataFrame]:
    """``docs`` in chunks, and chunk, row, id, n_shingles, component and the least id there (both null without words)."""
    chunks = exchange.pack(docs, text_col)
    sets = exchange.written(chunks.select("chunk", "data").mapInArrow(_describe(id_col, text_col, length), _SET_DDL))
    alike = sets.filter("n_shingles > 0").groupBy("print_a", "print_b").agg(
        F.min("id").alias("least"), F.min(F.struct("chunk", "row")).alias("one"), F.first("n_shingles").alias("size")
    )
    alike = exchange.written(alike.select(
        "print_a", "print_b", "least", "size", ((F.col("one.chunk") * (1 << 16)) + F.col("one.row")).alias("set")
    ))
    links = exchange.written(_links(chunks, sets, alike, text_col, percent, length))
    label = components(links, "a", "b")
    # classes of sets, then of documents
    of_set = alike.join(label.withColumnRenamed("node", "set"), "set", "left").select(
        "print_a", "print_b", "least", F.coalesce("component", "set").alias("component")
    )
    smallest = of_set.groupBy("component").agg(F.min("least").alias("least"))
    of_set = of_set.drop("least").join(smallest, "component").select("print_a", "print_b", "component", "least")
    rows = sets.drop("sketch").join(of_set, ["print_a", "print_b"], "left")
    return chunks, rows.select("chunk", "row", "id", "n_shingles", "component", "least")


_SET_DDL = "chunk long, row int, id long, n_shingles long, print_a long, print_b long, sketch binary"


def _sketch(shingle: np.ndarray) -> bytes:
    """Numbers of shingles in equal ranges of the domain, about one or two in each."""
    cells = max(5, len(shingle).bit_length() - 1)
    return np.bincount((shingle >> _U(64 - cells)).astype(np.int64), minlength=1 << cells).clip(max=255).astype(np.uint8).tobytes()


def _may_link(one: np.ndarray, two: np.ndarray, sizes: int, percent: int) -> bool:
    """False only where the sketches prove that the sets do not link: each range's difference is in the symmetric one."""
    cells = min(len(one), len(two))
    x, y = (v.reshape(cells, -1).sum(axis=1, dtype=np.int64) for v in (one, two))
    most = (sizes - int(np.abs(x - y).sum())) // 2
    return 100 * most >= percent * (sizes - most)


def _describe(id_col: str, text_col: str, length: int):
    schema = exchange.arrow_schema(_SET_DDL)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column("chunk").to_pylist(), batch.column("data"), strict=True):
                table = exchange.from_bytes(data.as_buffer())
                ids = pc.fill_null(table.column(id_col).cast(pa.int64()), _LAST).to_numpy()
                for rows in row_slices(table.column(text_col), np.arange(table.num_rows)):
                    sets = shingle_sets(table.column(text_col).slice(rows[0], len(rows)), length)
                    prints = [mix(_sums(mix(sets.shingle, s), sets.first) + sets.sizes.astype(_U), s).view(np.int64) for s in (21, 22)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(rows), number)), pa.array(rows, pa.int32()), pa.array(ids[rows]), pa.array(sets.sizes, pa.int64()),
                        pa.array(prints[0]), pa.array(prints[1]),
                        pa.array([_sketch(sets.shingle[a:b]) for a, b in zip(sets.first[:-1], sets.first[1:], strict=True)], pa.binary()),
                    ], schema=schema)
                release_memory()

    return each


def _links(chunks: DataFrame, sets: DataFrame, alike: DataFrame, text_col: str, percent: int, length: int) -> DataFrame:
    """Pairs (a, b) of sets that link and connect all that links connect. A set is named chunk * 65536 + row."""
    parts = exchange.parts_of(chunks)
    # which rows of a chunk stand for their set
    members = alike.select(F.shiftright("set", 16).alias("chunk"), F.col("set").bitwiseAND(0xFFFF).cast("int").alias("row"))
    verify = partial(_verify, chunks, sets, alike, text_col, percent, length)

    def sign(number: int, table: pa.Table, got: np.ndarray) -> Iterator[pa.Table]:
        texts, held = table.column(text_col), []
        for rows in row_slices(texts, got):
            signature, row, slack = signatures(shingle_sets(texts.take(pa.array(rows)), length), percent)
            held.append((signature, rows[row].astype(np.uint16), slack.clip(0, 255).astype(np.uint8)))
        if not held:
            return
        signature, row, slack = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(signature, kind="stable")
        signature, row, slack = signature[order], row[order], slack[order]
        bounds = exchange.part_bounds(signature, parts)
        # the part says the high bits; of the others 40 are sent, as sets that share those alone do no harm
        low, high = signature.astype(np.uint32), (signature >> _U(32)).astype(np.uint8)
        sent = (
            (int(p), low[a:b].tobytes() + row[a:b].tobytes() + high[a:b].tobytes() + slack[a:b].tobytes())
            for p in np.flatnonzero(np.diff(bounds)) for a, b in [(bounds[p], bounds[p + 1])]
        )
        yield pa.Table.from_batches([exchange.messages(number, sent)])

    # buckets: sets with one signature, kept as flat arrays
    buckets = exchange.written(_per_chunk(chunks, members, sign, exchange.SENT_DDL).groupBy("part").applyInArrow(_buckets, "data binary"))
    stars = exchange.written(buckets.mapInArrow(_stars, "a long, b long").distinct())
    first = exchange.written(verify(stars))
    few, many = _rest(buckets, stars, components(first, "a", "b"))
    if not few.isEmpty():
        first = exchange.written(first.unionByName(verify(few)))
    if many.isEmpty():
        return first
    # sets of frequent signatures: compared with some hubs of their group, then what is left with the whole group
    group = _grouped(many)
    first = exchange.written(first.unionByName(verify(_to_hubs(_labelled(group, first)))))
    return first.unionByName(_by_blocks(chunks, _labelled(group, first), text_col, percent, length))


def _per_chunk(chunks: DataFrame, rows: DataFrame, work, ddl: str | StructType) -> DataFrame:
    """``work`` gets number and table of each chunk with the sorted rows that are asked for, if any, and gives tables.

    What is asked for is one bit per row of a chunk. Below ``MASK_BYTES`` in all (checked by the number of chunks) the
    masks are broadcast and the chunks stay where they are; beyond it both are shuffled by chunk.
    """
    schema = exchange.arrow_schema(ddl)

    def pack(table: pa.Table) -> pa.Table:
        asked = np.zeros(exchange.CHUNK_ROWS, np.uint8)
        asked[table.column("row").to_numpy()] = 1
        return pa.table([table.column("chunk")[:1], pa.array([np.packbits(asked).tobytes()], pa.binary())], ["chunk", "asked"])

    def one(number: int, data, asked) -> Iterator[pa.RecordBatch]:
        got = np.flatnonzero(np.unpackbits(np.frombuffer(asked, np.uint8)))
        for table in work(number, exchange.from_bytes(data), got):
            yield from table.cast(schema).combine_chunks().to_batches()
        release_memory()

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        found = one(left.column("chunk")[0].as_py(), left.column("data")[0].as_buffer(), right.column("asked")[0].as_buffer())
        return pa.Table.from_batches(list(found), schema)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data, asked in zip(batch.column("chunk").to_pylist(), batch.column("data"), batch.column("asked"), strict=True):
                yield from one(number, data.as_buffer(), asked.as_buffer())

    masks = rows.groupBy("chunk").applyInArrow(pack, "chunk long, asked binary")
    held = chunks.select("chunk", "data")
    if chunks.count() * (exchange.CHUNK_ROWS // 8) <= MASK_BYTES:
        return held.join(F.broadcast(masks), "chunk").select("chunk", "data", "asked").mapInArrow(mapped, ddl)
    return held.groupBy("chunk").cogroup(masks.groupBy("chunk")).applyInArrow(each, ddl)


def _buckets(table: pa.Table) -> pa.Table:
    """Of the messages to a part: sizes of the buckets of two or more sets, their signatures, members, and slacks."""
    held = [(c, memoryview(x.as_buffer())) for c, x in zip(table.column("chunk").to_pylist(), table.column("data"), strict=True)]
    sizes = [len(m) // 8 for _, m in held]
    signature = np.concatenate([
        np.frombuffer(m, np.uint32, n) | np.frombuffer(m, np.uint8, n, 6 * n).astype(_U) << _U(32)
        for (_, m), n in zip(held, sizes, strict=True)
    ])
    member = np.concatenate([
        np.frombuffer(m, np.uint16, n, 4 * n).astype(np.int64) + (c << 16) for (c, m), n in zip(held, sizes, strict=True)
    ])
    slack = np.concatenate([np.frombuffer(m, np.uint8, n, 7 * n) for (_, m), n in zip(held, sizes, strict=True)])
    order = np.lexsort((member, signature))
    signature, member, slack = signature[order], member[order], slack[order]
    begin = np.flatnonzero(np.append(True, signature[1:] != signature[:-1]))
    size = np.diff(np.append(begin, len(signature)))
    shared = np.repeat(size > 1, size)
    packed = pa.table({"signature": signature[shared], "member": member[shared], "slack": slack[shared]})
    release_memory()
    return pa.table({"data": [exchange.to_bytes(packed)]}, schema=pa.schema([("data", pa.binary())]))


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first member of each bucket with each other member."""
    for batch in batches:
        for data in batch.column("data"):
            table = exchange.from_bytes(data.as_buffer())
            signature, member = table.column("signature").to_numpy(), table.column("member").to_numpy()
            if not len(member):
                continue
            new = np.append(True, signature[1:] != signature[:-1])
            hub = member[np.flatnonzero(new)[np.cumsum(new) - 1]]
            pairs = np.unique(np.stack([hub[~new], member[~new]], axis=1), axis=0)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])


def _rest(buckets: DataFrame, stars: DataFrame, label: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What shares a signature and is in different classes so far: pairs by rare signatures, members of frequent ones.

    A set whose slack exceeds the number of its frequent signatures is sure to share a rare one with each partner, so
    its frequent ones are left out.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data"):
                table = exchange.from_bytes(data.as_buffer())
                signature, n = np.unique(table.column("signature").to_numpy(), return_counts=True)
                size = np.repeat(n, n)
                yield pa.RecordBatch.from_arrays([
                    pa.array(mix(np.repeat(signature, n)).view(np.int64)), table.column("member").combine_chunks(),
                    pa.array(table.column("slack").to_numpy().astype(np.int32)), pa.array(size > FREQUENT),
                ], ["signature", "node", "slack", "frequent"])

    held = buckets.mapInArrow(rows, "signature long, node long, slack int, frequent boolean")
    held = held.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = held.groupBy("signature").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    held = exchange.written(held.join(mixed.select("signature"), "signature", "left_semi"))
    frequent = held.filter("frequent").groupBy("node").agg(F.count("*").alias("n_frequent"), F.min("slack").alias("slack"))
    stuck = frequent.filter("n_frequent >= slack").select("node")
    many = exchange.written(held.filter("frequent").join(stuck, "node", "left_semi").select("signature", "node"))
    rare = held.filter("NOT frequent")
    one = rare.select("signature", F.col("node").alias("a"), F.col("component").alias("ca"))
    two = rare.select("signature", F.col("node").alias("b"), F.col("component").alias("cb"))
    pairs = one.join(two, "signature").filter("a < b AND ca != cb").select("a", "b").distinct()  # at most FREQUENT each
    return exchange.written(pairs.join(stars, ["a", "b"], "left_anti")), many


def _grouped(many: DataFrame) -> DataFrame:
    """(node, grp): sets that frequent signatures connect, similar or not."""
    hub = many.groupBy("signature").agg(F.min("node").alias("hub"))
    joined = components(many.join(hub, "signature").select("hub", "node"), "hub", "node")
    return exchange.written(joined.select("node", F.col("component").alias("grp")))


def _labelled(group: DataFrame, links: DataFrame) -> DataFrame:
    """node, grp, component so far, and whether that is the largest of its group."""
    rows = group.join(components(links, "a", "b"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = rows.groupBy("grp", "component").agg(F.count("*").alias("n"))
    top = sizes.groupBy("grp").agg(F.max(F.struct("n", "component"))["component"].alias("top"), F.sum("n").alias("size"))
    return exchange.written(rows.join(top, "grp").withColumn("inner", F.col("component") == F.col("top")).drop("top"))


def _to_hubs(rows: DataFrame) -> DataFrame:
    """Each set outside the largest class of its group with ``HUBS`` sets of that class."""
    hubs = rows.filter("inner").groupBy("grp").agg(
        F.array(*[F.min(F.struct(F.xxhash64("node", F.lit(k)), "node"))["node"] for k in range(HUBS)]).alias("hubs")
    )
    pairs = rows.filter("NOT inner").join(hubs, "grp").select("node", F.explode(F.array_distinct("hubs")).alias("hub"))
    return exchange.written(pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())


def _by_blocks(chunks: DataFrame, rows: DataFrame, text_col: str, percent: int, length: int) -> DataFrame:
    """Links of the sets outside the largest class of their group with all sets of the group.

    Blocks of sets meet as matrices of shingles; a pair of blocks is one row, and it gives only links, one for each
    set and class that it meets.
    """
    whole = exchange.written(_sets_of(chunks, rows.select("node"), text_col, length))
    packed = rows.join(whole, "node").withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK)))

    def pack(table: pa.Table) -> pa.Table:
        held = table.select(["node", "component", "shingles"])
        return pa.table([table.column("grp")[:1], pa.array([exchange.to_bytes(held)], pa.binary())], ["grp", "data"])

    def blocks(some: DataFrame) -> DataFrame:
        some = some.select("grp", "block", "node", "component", "shingles")
        return exchange.written(some.groupBy("grp", "block").applyInArrow(pack, "grp long, data binary"))

    asked = blocks(packed.filter("NOT inner")).withColumnRenamed("data", "asked")
    cells = asked.join(blocks(packed), "grp").repartition(F.xxhash64("asked", "data"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(batch.column("asked"), batch.column("data"), strict=True):
                a, b = (exchange.from_bytes(x.as_buffer()) for x in (one, two))
                x, y = _matching(a, b, percent)
                left, right = a.column("node").to_numpy()[x], b.column("node").to_numpy()[y]
                _, at = np.unique(np.stack([left, b.column("component").to_numpy()[y]]), axis=1, return_index=True)
                at = at[left[at] != right[at]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(left, right)[at]), pa.array(np.maximum(left, right)[at])], ["a", "b"]
                )

    return cells.mapInArrow(meet, "a long, b long")


def _matching(one: pa.Table, two: pa.Table, percent: int, width: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two blocks whose sets link, other than a set with itself."""
    sets = [[np.frombuffer(x.as_buffer(), _U) for x in t.column("shingles")] for t in (one, two)]
    sizes = [np.array([len(s) for s in side]) for side in sets]
    flat = [np.concatenate(side) for side in sets]
    row = [np.repeat(np.arange(len(n)), n) for n in sizes]
    both = np.intersect1d(*flat)
    common = np.zeros((len(sizes[0]), len(sizes[1])))
    for at in range(0, len(both), width):
        part = both[at : at + width]
        held = []
        for key, r, n in zip(flat, row, sizes, strict=True):
            place = np.searchsorted(part, key).clip(max=len(part) - 1)
            some = part[place] == key
            matrix = np.zeros((len(n), len(part)), np.float32)
            matrix[r[some], place[some]] = 1
            held.append(matrix)
        common += held[0] @ held[1].T
    union = sizes[0][:, None] + sizes[1][None, :] - common
    other = one.column("node").to_numpy()[:, None] != two.column("node").to_numpy()[None, :]
    return np.nonzero((100 * common >= percent * union) & other)


def _verify(
    chunks: DataFrame, sets: DataFrame, alike: DataFrame, text_col: str, percent: int, length: int, pairs: DataFrame
) -> DataFrame:
    """Pairs whose sets link: sizes, then sketches rule most others out, what is left is compared on hashed shingles."""
    sizes = alike.select(F.col("set").alias("node"), F.col("size").alias("n"))
    met = (
        pairs.join(sizes.selectExpr("node AS a", "n AS na"), "a").join(sizes.selectExpr("node AS b", "n AS nb"), "b")
        .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    )
    # sketches are long, so they are read for the pairs that sizes leave
    met = exchange.written(met.select("a", "b", (F.col("na") + F.col("nb")).alias("size")))
    node = ((F.col("chunk") * (1 << 16)) + F.col("row")).alias("node")
    known = sets.select(node, "sketch").join(met.select(F.col("a").alias("node")).union(met.select("b")).distinct(), "node", "left_semi")
    known = exchange.written(known)
    met = met.join(known.selectExpr("node AS a", "sketch AS sa"), "a").join(known.selectExpr("node AS b", "sketch AS sb"), "b")

    def plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                _may_link(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8), n, percent)
                for x, y, n in zip(batch.column("sa"), batch.column("sb"), batch.column("size").to_pylist(), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release_memory()

    near = exchange.written(met.mapInArrow(plausible, "a long, b long"))
    nodes = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    whole = exchange.written(_sets_of(chunks, nodes, text_col, length))
    met = near.join(whole.selectExpr("node AS a", "shingles AS sa"), "a").join(whole.selectExpr("node AS b", "shingles AS sb"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = np.frombuffer(one.as_buffer(), _U), np.frombuffer(two.as_buffer(), _U)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            release_memory()

    return met.mapInArrow(compare, "a long, b long")


def _sets_of(chunks: DataFrame, nodes: DataFrame, text_col: str, length: int) -> DataFrame:
    """(node, shingles) of distinct nodes, from the texts."""
    wanted = nodes.select(F.shiftright("node", 16).alias("chunk"), F.col("node").bitwiseAND(0xFFFF).cast("int").alias("row"))

    def fetch(number: int, table: pa.Table, got: np.ndarray) -> Iterator[pa.Table]:
        texts = table.column(text_col)
        for rows in row_slices(texts, got):
            found = shingle_sets(texts.take(pa.array(rows)), length)
            data = [found.shingle[a:b].tobytes() for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
            yield pa.table({"node": pa.array(rows.astype(np.int64) + (number << 16)), "shingles": pa.array(data, pa.binary())})

    return _per_chunk(chunks, wanted, fetch, "node long, shingles binary")
