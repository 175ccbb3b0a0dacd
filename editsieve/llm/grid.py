"""Blocks of vectors, and a grid of query blocks against candidate blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from editsieve.llm.exchange import from_bytes, to_bytes
from editsieve.llm.words import mix
from editsieve.session import cut_lineage

CANDIDATES = 16_384
QUERIES = 512
_BLOCK_DDL = "dim int, block int, data binary"
_FOUND_DDL = "query_id long, vec_id long, score {kind}"


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and vector of the rows that take part: id and components not null, components finite."""
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & ~bad
    return rows.filter(some).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))


def blocks(rows: DataFrame, count: int, each: int) -> DataFrame:
    """Rows in blocks of about ``each`` vectors of one length, by a hash of the id; of equal ids the least vector stays."""
    number = max(1, -(-count // each))

    def pack(table: pa.Table) -> pa.Table:
        table = table.select(["vec_id", "vec"]).combine_chunks()
        ids = table.column("vec_id").to_numpy()
        vectors = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        order = np.lexsort((*vectors.T[::-1], ids))
        ids, vectors = ids[order], vectors[order]
        new = np.append(True, ids[1:] != ids[:-1])
        ids, vectors = ids[new], vectors[new]
        held = pa.table({"id": ids, "vec": pa.FixedSizeListArray.from_arrays(pa.array(vectors.ravel()), vectors.shape[1])})
        return pa.table({
            "dim": pa.array([vectors.shape[1]], pa.int32()), "block": pa.array(_block_of(ids[:1], number)),
            "data": pa.array([to_bytes(held)], pa.binary()),
        })

    def numbered(batches):
        for batch in batches:
            block = _block_of(batch.column("vec_id").to_numpy(), number)
            dim = pc.list_value_length(batch.column("vec")).cast(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), dim, pa.array(block, pa.int32())], ["vec_id", "vec", "dim", "block"])

    keyed = rows.mapInArrow(numbered, "vec_id long, vec array<double>, dim int, block int")
    return cut_lineage(keyed.groupBy("dim", "block").applyInArrow(pack, _BLOCK_DDL))


def _block_of(ids: np.ndarray, number: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64), 41) % np.uint64(number)).astype(np.int32)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    table = from_bytes(data)
    ids = table.column("id").to_numpy()
    return ids, table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)


def meet(
    queries: DataFrame, candidates: DataFrame, query_blocks: int, work: Callable, kind: str, k: int
) -> DataFrame:
    """The ``k`` best of what ``work`` finds for each query in each block: query_id, rank, vec_id, score.

    ``work`` gets ids and vectors of a block of queries and of a block of candidates and gives query ids, candidate
    ids and scores, at most ``k`` a query. Each pair of blocks is one task; what a pair finds is small.
    """
    ddl = _FOUND_DDL.format(kind=kind)
    arrow = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64() if kind == "long" else pa.float64())])

    def pair(table: pa.Table) -> pa.Table:
        out = []
        for data, other in zip(table.column("data"), table.column("asked"), strict=True):
            found = work(*unpack(other.as_buffer()), *unpack(data.as_buffer()))
            out.append(pa.table([pa.array(x, f.type) for x, f in zip(found, arrow, strict=True)], schema=arrow))
        return pa.concat_tables(out)

    asked = queries.select("dim", F.col("block").alias("asked_block"), F.col("data").alias("asked"))
    cells = candidates.withColumn("asked_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    found = cells.join(asked, ["dim", "asked_block"]).groupBy("dim", "block", "asked_block").applyInArrow(pair, ddl)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(rows: DataFrame, asked, work: Callable, kind: str, k: int, id_col: str, vec_col: str) -> DataFrame:
    """Queries are the usable rows for which ``asked`` (a condition on ``vec_id``) holds, candidates all usable rows."""
    held = usable(rows, id_col, vec_col)
    count = held.agg(F.count("*").alias("n"), F.count_if(asked).alias("q")).first()
    number = max(1, -(-count["q"] // QUERIES))
    return meet(blocks(held.filter(asked), count["q"], QUERIES), blocks(held, count["n"], CANDIDATES), number, work, kind, k)
