"""Documents as compressed chunks, and shuffles of flat arrays between chunks and parts of a key space.

Shuffling one row per word costs more than the work on the words. Here a chunk (some megabytes of documents, one row)
sends one binary row to each part of a hashed key space that it has keys in; a part merges what the chunks sent, and
may answer each of them. Keys are deduplicated within a chunk first, so a frequent key arrives once per chunk, not
once per occurrence. The number of parts follows the number of words, so that a part stays small at any input size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from editsieve.session import cut_lineage, shared_dir
from editsieve.llm.words import split_words

CHUNK_BYTES = 8 << 20
CHUNK_ROWS = 60_000
PART_WORDS = 1 << 19
CHUNK_SCHEMA = "chunk long, words long, data binary"


def to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def from_bytes(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: unlike a checkpoint it carries no constraints into later plans.

    An iterative plan gathers constraints between columns with every step, until planning takes longer than running.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack(docs: DataFrame, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """All columns of ``docs`` in chunks of about ``chunk_bytes`` of text, written to the shared folder.

    A document longer than that is a chunk of its own. An empty table gives no chunk.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size, rows = [], 0, 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
            ends, at = np.cumsum(lengths, dtype=np.int64), 0
            while at < batch.num_rows:
                base = ends[at - 1] if at else 0
                upto = int(np.searchsorted(ends, base + chunk_bytes - size, "right"))
                upto = min(max(upto, at + (size == 0)), at + CHUNK_ROWS - rows, batch.num_rows)
                if upto > at:
                    # a copy, so that the batch that Spark sent can go
                    held.append(pa.RecordBatch.from_pylist(batch.slice(at, upto - at).to_pylist(), batch.schema) if upto - at < 8 else batch.slice(at, upto - at))
                    size, rows = size + int(ends[upto - 1] - base), rows + upto - at
                if upto < batch.num_rows or size >= chunk_bytes or rows >= CHUNK_ROWS:
                    yield chunk(number, held, text)
                    number, held, size, rows = number + 1, [], 0, 0
                at = upto
        if held:
            yield chunk(number, held, text)

    return cut_lineage(docs.mapInArrow(chunks, CHUNK_SCHEMA))


def chunk(number: int, held: list[pa.RecordBatch], text: str) -> pa.RecordBatch:
    table = pa.Table.from_batches(held)
    words = len(split_words(table.column(text)))
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([words], pa.int64()), pa.array([to_bytes(table)], pa.binary())],
        ["chunk", "words", "data"],
    )


def parts_of(chunks: DataFrame, words_each: int = PART_WORDS) -> int:
    """Parts of the key space: in proportion to the words, with some to spare for small inputs."""
    words = chunks.agg(F.sum("words")).first()[0] or 0
    return max(16, -(-words // words_each))


def part_bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins in sorted 64-bit keys; a part is a range of keys."""
    edges = (np.arange(parts + 1, dtype=np.float64) / parts * 2.0**64).clip(0, 2.0**64 - 2048).astype(np.uint64)
    bounds = np.searchsorted(keys, edges)
    bounds[0], bounds[-1] = 0, len(keys)
    return bounds


def rows_out(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def arrow_schema(schema: str | StructType) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def extended(schema: StructType, ddl: str) -> StructType:
    """``schema`` with more fields."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


SENT = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("data", pa.binary())])
SENT_DDL = "part int, chunk long, data binary"


def send(chunks: DataFrame, work: Callable[[pa.Table], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """``work`` turns the table of a chunk into (part, bytes) messages."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column("chunk").to_pylist(), batch.column("data"), strict=True):
                yield messages(number, work(from_bytes(data.as_buffer())))

    return chunks.select("chunk", "data").mapInArrow(each, SENT_DDL)


def messages(number: int, sent: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    parts, data = [], []
    for part, message in sent:
        parts.append(part)
        data.append(message)
    return rows_out({"part": parts, "chunk": [number] * len(parts), "data": data}, SENT)


def answer(sent: DataFrame, work: Callable[[int, list[memoryview]], list[bytes]]) -> DataFrame:
    """``work`` gets the messages of a part and gives an answer to each, in order; None: no answer."""

    def each(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        held = [memoryview(x.as_buffer()) for x in table.column("data")]
        out = work(table.column("part")[0].as_py(), held)
        some = [k for k, x in enumerate(out) if x is not None]
        table = table.take(pa.array(some, pa.int64()))
        return pa.table([table.column("part"), table.column("chunk"), pa.array([out[k] for k in some], pa.binary())], schema=SENT)

    return sent.groupBy("part").applyInArrow(each, SENT_DDL)


def with_answers(
    chunks: DataFrame, answers: DataFrame, work: Callable[[int, pa.Table, list[tuple[int, memoryview]]], pa.Table], ddl: str | StructType
) -> DataFrame:
    """``work`` gets number and table of a chunk with the answers to it, ordered by part, and gives rows."""
    schema = arrow_schema(ddl)

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("part")
        got = [(p, memoryview(x.as_buffer())) for p, x in zip(right.column("part").to_pylist(), right.column("data"), strict=True)]
        out = []
        for number, data in zip(left.column("chunk").to_pylist(), left.column("data"), strict=True):
            out.append(work(number, from_bytes(data.as_buffer()), got))
        return pa.concat_tables(out).cast(schema) if out else schema.empty_table()

    return (
        chunks.select("chunk", "data").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(each, ddl)
    )
