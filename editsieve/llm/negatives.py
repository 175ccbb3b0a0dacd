"""Hard negatives: for an anchor and each of its positives, the best rows of other labels inside a score window.

Rows are dealt to tiles by two coordinates (the outermost two cuts of sort-tile-recursion, at quantiles that Spark
measures), and each tile is packed into an R-tree once, written, and then searched twice: for the best rows of the
anchor's own label, and for the best rows of other labels inside the windows that these positives open. A search of a
tree by a block of anchors is a task; what it finds is small and merged by rank. Blocks are bounded in rows, whatever
the vectors, labels or ids have in common.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from editsieve.llm import exchange
from editsieve.llm.rtree import Search, Tree

SCALE = 256
ROWS = 8192  # of a tree
ANCHORS = 16_384  # of a block of anchors
CELLS = 48  # pairs of blocks at least, where there are rows for it
MOST_TILES = 1 << 16
LOW, HIGH, OF = 50, 95, 100  # a negative's score is between 50 / 100 and 95 / 100 of the positive's
POSITIVES, NEGATIVES = 5, 3

_TREE_DDL = "dim int, block long, data binary"
_ASKED_DDL = "dim int, asked_block long, asked binary"
_FOUND = pa.schema([("asked_block", pa.int64()), ("place", pa.int32()), ("window", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "asked_block long, place int, window long, vec_id long, score long"


def usable(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """vec_id, vec (floor(scale * x) of each component), label and dim of the rows that take part."""
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & ~bad
    vec = F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    held = rows.filter(some).select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"), F.col(label_col).cast("long").alias("label"))
    return held.withColumn("dim", F.size("vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _narrow(vectors: np.ndarray) -> np.ndarray:
    """In the smallest integers that hold them."""
    most = max(abs(int(vectors.min())), abs(int(vectors.max())))
    return vectors.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def _held(table: pa.Table, vectors: np.ndarray) -> bytes:
    flat = pa.FixedSizeListArray.from_arrays(pa.array(_narrow(vectors).ravel()), vectors.shape[1])
    return exchange.to_bytes(pa.table({"vec_id": table.column("vec_id"), "label": table.column("label"), "vec": flat}))


def _unpack(data) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = exchange.from_bytes(data)
    return table.column("vec_id").to_numpy(), table.column("label").to_numpy(), _matrix(table.column("vec"))


def tiles(held: DataFrame, count: int, rows: int = ROWS) -> DataFrame:
    """``held`` with its block: a tile of the first two coordinates, cut by a hash where it has more than ``rows`` rows.

    Quantiles of the first coordinate, and of the second within each slab, are at most ``MOST_TILES`` numbers.
    """
    number = min(max(1, -(-count // rows)), MOST_TILES)
    slabs = max(1, round(number**0.5))
    each = -(-number // slabs)
    first, second = F.get("vec", F.lit(0)), F.coalesce(F.get("vec", F.lit(1)), F.lit(0))
    slab = tile = F.lit(0)
    if slabs > 1:
        cuts = held.agg(F.percentile_approx(first, [k / slabs for k in range(1, slabs)])).first()[0]
        slab = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < first))
    held = held.withColumn("slab", slab)
    if each > 1:
        cuts = held.groupBy("slab").agg(F.percentile_approx(second, [k / each for k in range(1, each)]).alias("cuts"))
        held = held.join(F.broadcast(cuts), "slab")  # at most MOST_TILES numbers
        tile = F.size(F.filter("cuts", lambda c: c < second))
    held = held.withColumn("tile", F.col("slab") * each + tile).select("vec_id", "vec", "label", "dim", "tile")
    sizes = held.groupBy("dim", "tile").agg(F.ceil(F.count("*") / rows).alias("parts")).filter("parts > 1")
    # at most one row of three numbers for every ``rows`` rows, and MOST_TILES for each length of vectors
    held = held.withColumn("row", F.monotonically_increasing_id()).join(sizes, ["dim", "tile"], "left")
    part = F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(1)))
    return held.withColumn("block", F.col("tile").cast("long") * (1 << 32) + part)


def trees(held: DataFrame, count: int, rows: int = ROWS) -> DataFrame:
    """One row per block with its packed tree; only what cannot be had from it again cheaply is kept: rows in page order."""

    def pack(table: pa.Table) -> pa.Table:
        vectors = _matrix(table.column("vec"))
        tree = Tree.of(table.column("vec_id").to_numpy(), table.column("label").to_numpy(), vectors)
        ordered = pa.table({"vec_id": tree.ids, "label": tree.label})
        box = pa.table({"begin": tree.begin, "end": tree.end, "low": list(tree.low), "high": list(tree.high)})
        box = box.replace_schema_metadata({"leaves": str(tree.leaves)})
        data = _joined(_held(ordered, tree.vectors), exchange.to_bytes(box))
        return table.select(["dim", "block"]).slice(0, 1).append_column("data", pa.array([data], pa.binary()))

    blocks = tiles(held, count, rows).select("vec_id", "vec", "label", "dim", "block")
    return exchange.written(blocks.groupBy("dim", "block").applyInArrow(pack, _TREE_DDL))


def _joined(one: bytes, two: bytes) -> bytes:
    return len(one).to_bytes(8, "little") + one + two


def _tree(data) -> Tree:
    data = memoryview(data)
    size = int.from_bytes(data[:8], "little")
    ids, label, vectors = _unpack(data[8 : 8 + size])
    box = exchange.from_bytes(data[8 + size :])
    low, high = (np.stack(box.column(x).to_numpy()) for x in ("low", "high"))
    leaves = int(box.schema.metadata[b"leaves"])
    return Tree(ids, label, vectors, low, high, box.column("begin").to_numpy(), box.column("end").to_numpy(), leaves)


def anchor_blocks(held: DataFrame, number: int) -> DataFrame:
    """Anchors in ``number`` blocks of about equal size, dealt by row: rows of one id or vector are spread like others."""

    def pack(table: pa.Table) -> pa.Table:
        data = _held(table, _matrix(table.column("vec")))
        return pa.table(
            {"dim": table.column("dim")[:1], "asked_block": table.column("asked_block")[:1], "asked": pa.array([data], pa.binary())}
        )

    block = F.col("dim").cast("long") * (1 << 32) + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(number))
    return exchange.written(held.withColumn("asked_block", block).groupBy("dim", "asked_block").applyInArrow(pack, _ASKED_DDL))


def _searched(forest: DataFrame, anchors: DataFrame, tasks: int, work) -> DataFrame:
    """``work`` (tree, row of the anchors' block) gives places, windows, ids and scores; a pair of blocks is one row.

    Names alone are paired first. What is broadcast has one row of two numbers for every block of anchors.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cell = {name: batch.column(name)[row] for name in batch.schema.names}
                block = cell["asked_block"].as_py()
                place, window, ids, scores = work(_tree(cell["data"].as_buffer()), cell)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ids), block, np.int64)), pa.array(place.astype(np.int32)),
                    pa.array(window.astype(np.int64)), pa.array(ids), pa.array(scores.astype(np.int64)),
                ], schema=_FOUND)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in each(batches):
            held.append(batch)
            rows += batch.num_rows
            if rows >= 10_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    cell, names = ["dim", "asked_block", "block"], F.broadcast(anchors.select("dim", "asked_block"))
    asked = forest.select("dim", "block").join(names, "dim").join(anchors, ["dim", "asked_block"])
    met = forest.join(names, "dim").repartition(tasks, *cell).join(asked.repartition(tasks, *cell), cell)
    return met.drop("dim", "block").mapInArrow(gathered, _FOUND_DDL)


def mine(
    rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    scale: int = SCALE, block_rows: int = ROWS, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the usable rows for which ``anchor`` (a condition on ``vec_id``) holds. A score is the integer inner
    product of floor(scale * x); higher scores come first, ties by smaller id. The positives of an anchor are its first
    ``positives`` other rows of its label; the negatives of a positive the first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score`` (so none for a negative positive_score).

    Rows with a null id or label, a null or empty vector or a null or non-finite component take no part; only vectors
    of one length meet. A repeated row is a row of its own: it is an anchor, a positive or a negative as often as it is
    there, and only the anchor's own row is left out of its positives. An empty table gives no rows. Nothing is capped.
    """
    held = usable(rows, id_col, vec_col, label_col, scale)
    count = held.agg(F.count("*").alias("n"), F.count_if(anchor).alias("q")).first()
    forest = trees(held, count["n"], block_rows)
    blocks = forest.count()
    number = max(1, -(-count["q"] // ANCHORS), min(-(-CELLS // max(1, blocks)), -(-count["q"] // 64)))
    asked = anchor_blocks(held.filter(anchor), number)
    tasks = max(1, min(blocks * number, max(CELLS, blocks * number // 4)))

    def positive(tree: Tree, cell: dict):
        ids, label, vectors = _unpack(cell["asked"].as_buffer())
        place, *found = Search(tree, vectors).best_of(np.arange(len(ids)), label, positives + 1)
        return place, np.zeros(len(place), np.int64), *found

    found = _searched(forest, asked, tasks, positive).drop("window")
    known = asked.mapInArrow(_own, "asked_block long, place int, anchor_id long, own long")
    by_rank = Window.partitionBy("asked_block", "place").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("r", F.row_number().over(by_rank)).filter(F.col("r") <= positives + 1)
    found = found.join(known, ["asked_block", "place"])
    # the anchor's own row is among the first, or others are better; of equal entries any one may stand for it
    own = F.when((F.col("vec_id") == F.col("anchor_id")) & (F.col("score") == F.col("own")), F.col("r"))
    found = found.withColumn("self", F.min(own).over(Window.partitionBy("asked_block", "place")))
    found = found.filter("self IS NULL OR r != self").withColumn("r", F.row_number().over(by_rank)).filter(F.col("r") <= positives)
    found = exchange.written(
        found.select("asked_block", "place", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    )

    def windows(table: pa.Table) -> pa.Table:
        some = table.select(["place", "positive_score"]).group_by(["place", "positive_score"]).aggregate([])
        return table.select(["asked_block"]).slice(0, 1).append_column("opened", pa.array([exchange.to_bytes(some)], pa.binary()))

    opened = found.filter(F.col("positive_score") >= 0).groupBy("asked_block").applyInArrow(windows, "asked_block long, opened binary")

    def negative(tree: Tree, cell: dict):
        _, label, vectors = _unpack(cell["asked"].as_buffer())
        table = exchange.from_bytes(cell["opened"].as_buffer()).sort_by("place")
        place, score = table.column("place").to_numpy(), table.column("positive_score").to_numpy()
        ends = [(-(-low * s // OF), high * s // OF) for s in score.tolist()]
        below, above = (np.array(x, np.int64) for x in zip(*ends, strict=True))
        asked, owner = np.unique(place, return_inverse=True)
        window, *found = Search(tree, vectors).within_of(asked, label[asked], owner, below, above, negatives)
        return place[window], score[window], *found

    hard = _searched(forest, asked.join(opened, "asked_block"), tasks, negative)
    by_rank = Window.partitionBy("asked_block", "place", "window").orderBy(F.col("score").desc(), "vec_id")
    hard = hard.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= negatives)
    hard = hard.select("asked_block", "place", F.col("window").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(hard, ["asked_block", "place", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each anchor's id, and its score with itself."""
    for batch in batches:
        for block, data in zip(batch.column("asked_block").to_pylist(), batch.column("asked"), strict=True):
            ids, _, vectors = _unpack(data.as_buffer())
            own = (vectors.astype(np.int64) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), block, np.int64)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids), pa.array(own)],
                ["asked_block", "place", "anchor_id", "own"],
            )
