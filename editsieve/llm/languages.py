"""Language identification by nearest centroid over normalised TF-IDF vectors of letter n-grams.

A text is lower-cased, what is not a letter in ASCII separates words, runs with digits are left out, and every n-gram of 2 to 4 bytes counts in one of
a fixed number of buckets. The document frequencies of the buckets are counted over all documents that may be learned
from. Each language gets several centroids by spherical clustering of a bounded sample of its documents. A text takes
the language of the centroid of largest cosine; one that is further from it than nearly all documents that the centroid
was made of is called far, and may be rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from editsieve.llm.exchange import arrow_schema
from editsieve.llm.words import bytes_of

ORDERS = (2, 3, 4)
BUCKETS = 1 << 13
MAX_SAMPLE = 1000  # documents of a language that its centroids are made of
CENTROIDS = 4
ROUNDS = 12
FAR = 0.005  # share of a centroid's own documents that lie further away than its bound
NONE = "und"
_ROWS, _BYTES = 256, 1 << 20
_SPACE = 0x20
_KEPT = np.arange(256, dtype=np.uint8)
_KEPT[:0x41] = _KEPT[0x5B:0x61] = _KEPT[0x7B:0x80] = _SPACE


def grams(texts: pa.Array) -> np.ndarray:
    """Counts of the n-grams of each text, one column per bucket. A null text has none."""
    rows = len(texts)
    padded = pc.binary_join_element_wise(" ", pc.utf8_lower(pc.fill_null(texts, "")), " ", "")
    data, offsets = bytes_of(padded)
    out = np.zeros(rows * BUCKETS, np.float32)
    longest = max(ORDERS)
    data = letters_only(data)
    for at in range(0, len(data), _BYTES):
        piece = data[at : at + _BYTES + longest - 1]
        own = min(_BYTES, len(data) - at)
        row = np.searchsorted(offsets, np.arange(at, at + len(piece)), "right") - 1
        code = piece.astype(np.uint32)
        key = code
        for n in range(2, longest + 1):
            size = min(own, len(piece) - n + 1)
            if size <= 0:
                break
            key = (key[:-1] << np.uint32(8)) | code[n - 1 :]
            if n not in ORDERS:
                continue
            some = row[:size] == row[n - 1 : n - 1 + size]
            # two separators behind each other say nothing
            first, last = piece[:size] == _SPACE, piece[n - 1 : n - 1 + size] == _SPACE
            some &= ~(first & (piece[1 : 1 + size] == _SPACE)) & ~(last & (piece[n - 2 : n - 2 + size] == _SPACE))
            bucket = (key[:size][some] * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
            out += np.bincount(row[:size][some] * BUCKETS + bucket, minlength=len(out)).astype(np.float32)
    return out.reshape(rows, BUCKETS)


def letters_only(data: np.ndarray) -> np.ndarray:
    """``data`` with a space for each ASCII byte that is no letter, and for all of a run that has a digit (keys, numbers)."""
    out = _KEPT[data]
    digit = (data >= 0x30) & (data < 0x3A)
    if not digit.any():
        return out
    inside = digit | (out != _SPACE)
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    mixed = np.logical_or.reduceat(digit, begin)
    steps = np.zeros(len(data) + 1, np.int8)
    steps[begin[mixed]] = 1
    steps[end[mixed]] = -1
    out[np.cumsum(steps[:-1], dtype=np.int8) > 0] = _SPACE
    return out


def has_letter(texts: pa.Array) -> np.ndarray:
    found = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False)
    return (found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found).to_numpy(zero_copy_only=False)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF; a text without n-grams is zero."""
    out = np.log1p(counts) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Of at most 256 rows, and of about a megabyte where rows are long."""
    _, offsets = bytes_of(batch.column(text))
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(offsets, offsets[at] + _BYTES, "right")) - 1
        upto = min(max(upto, at + 1), at + _ROWS)
        yield batch.slice(at, min(upto, batch.num_rows) - at)
        at = upto


# ---- learning ----


def frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Number of documents that have each bucket, and of all documents: one row a bucket reaches the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for part in _slices(batch, 0):
                total[:BUCKETS] += (grams(part.column(0)) > 0).sum(axis=0)
                total[BUCKETS] += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS + 1)), pa.array(total)], ["bucket", "n"])

    out = np.zeros(BUCKETS + 1, np.int64)
    for r in texts.mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out[:BUCKETS], int(out[BUCKETS])


def sampled(docs: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` documents of each language, chosen by a hash."""
    sizes = docs.groupBy("lang").agg(F.count("*").alias("of"))
    held = docs.withColumn("chosen", F.xxhash64("id", "text"))
    # a generous share by hash alone comes first, so that little is ranked
    share = F.shiftrightunsigned("chosen", 33) / F.lit(float(1 << 31))
    held = held.join(F.broadcast(sizes), "lang").filter(share * F.col("of") <= limit + 6 * limit**0.5)  # one row a language
    first = Window.partitionBy("lang").orderBy("chosen", "id", "text")
    return held.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= limit).select("lang", "chosen", "text")


def clustered(x: np.ndarray, count: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of the rows, and the centroid of each row: spherical clustering, begun with rows far apart."""
    nearest = x @ x.mean(axis=0)
    chosen = [int(np.argmax(nearest))]
    for _ in range(min(count, len(x)) - 1):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    centres = x[np.unique(chosen)]
    own = np.full(len(x), -1)
    for _ in range(rounds):
        new = np.argmax(x @ centres.T, axis=1)
        if (new == own).all():
            break
        own = new
        sums = np.stack([x[own == k].sum(axis=0) if (own == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres, np.argmax(x @ centres.T, axis=1)


@dataclass
class Model:
    idf: np.ndarray
    lang: list[str]  # of each centroid
    centres: np.ndarray
    bound: np.ndarray  # cosine below which a text is far from the centroid


_SPARSE_DDL = "lang string, chosen long, bucket binary, value binary"
_CENTRE = pa.schema([("lang", pa.string()), ("bound", pa.float64()), ("centre", pa.binary())])
_CENTRE_DDL = "lang string, bound double, centre binary"


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_sample: int = MAX_SAMPLE, count: int = CENTROIDS) -> Model:
    """Learns from the rows of ``docs`` with a language and a text with letters.

    Document frequencies are those of all rows. Centroids are made of at most ``max_sample`` documents of a language;
    a language is one group, bounded by that number.
    """
    held = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    held = held.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    df, total = frequencies(held.select("text"))
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 2):
                x = vectors(grams(part.column(2)), idf)
                places = [np.flatnonzero(v).astype(np.uint16) for v in x]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([p.tobytes() for p in places], pa.binary()),
                    pa.array([v[p].astype(np.float32).tobytes() for v, p in zip(x, places, strict=True)], pa.binary()),
                ], ["lang", "chosen", "bucket", "value"])

    def centred(table: pa.Table) -> pa.Table:
        table = table.sort_by([("chosen", "ascending"), ("bucket", "ascending"), ("value", "ascending")])
        x = np.zeros((table.num_rows, BUCKETS), np.float32)
        for v, places, values in zip(x, table.column("bucket"), table.column("value"), strict=True):
            v[np.frombuffer(places.as_buffer(), np.uint16)] = np.frombuffer(values.as_buffer(), np.float32)
        centres, own = clustered(x, count)
        cosine = (x * centres[own]).sum(axis=1)
        some = [k for k in range(len(centres)) if (own == k).any()]
        return pa.table({
            "lang": pa.array([table.column("lang")[0].as_py()] * len(some), pa.string()),
            "bound": pa.array([float(np.quantile(cosine[own == k], FAR)) for k in some]),
            "centre": pa.array([centres[k].astype(np.float32).tobytes() for k in some], pa.binary()),
        }, schema=_CENTRE)

    sample = sampled(held, max_sample).mapInArrow(described, _SPARSE_DDL)
    rows = sample.groupBy("lang").applyInArrow(centred, _CENTRE_DDL).collect()  # ``count`` a language
    rows.sort(key=lambda r: (r["lang"], r["centre"]))
    centres = np.stack([np.frombuffer(r["centre"], np.float32) for r in rows]) if rows else np.zeros((0, BUCKETS), np.float32)
    return Model(idf, [r["lang"] for r in rows], centres, np.array([r["bound"] for r in rows]))


# ---- prediction ----


def nearest(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Centroid of each text and the cosine with it; -1 and 0 without a letter or a model."""
    place, cosine = np.full(len(texts), -1), np.zeros(len(texts))
    some = np.flatnonzero(has_letter(texts)) if len(model.lang) else np.zeros(0, np.int64)
    if len(some):
        all_cosines = vectors(grams(texts.take(pa.array(some))), model.idf) @ model.centres.T
        place[some] = np.argmax(all_cosines, axis=1)
        cosine[some] = all_cosines.max(axis=1).clip(0, 1)
    return place, cosine


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", reject: bool = False) -> DataFrame:
    """``id_col``, lang_pred, score (cosine with the nearest centroid) and is_far of every row; nothing else is read.

    ``und`` with score 0 for a text that is null or has no letter, or if nothing was learned; with ``reject`` also for
    one that is far from its nearest centroid. Whole texts; of equally near centroids the first language in order counts.
    """
    schema = arrow_schema("lang_pred string, score double, is_far boolean")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                place, cosine = nearest(part.column(1), model)
                known = place >= 0
                far = ~known
                far[known] = cosine[known] < model.bound[place[known]]
                said = [NONE if p < 0 or reject and f else model.lang[p] for p, f in zip(place, far, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(said, pa.string()), pa.array(cosine), pa.array(far)], names=[id_col, *schema.names]
                )

    held = docs.select(id_col, text_col)
    ddl = f"`{id_col}` {held.schema[0].dataType.simpleString()}, lang_pred string, score double, is_far boolean"
    return held.mapInArrow(each, ddl)


def fold(id_col: str, count: int = 4) -> Column:
    """Fold of a row, by the crc32 of its id as text; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % count


def held_out(docs: DataFrame, held: int = 2, folds: int = 4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from all folds but one and predicts every row: id, held_out, lang_pred, score, is_far.

    A row with a null id is in no fold: it is predicted, not learned from, and not held out. Rows of one id are in one
    fold. Rows with a null language are predicted only. An empty table gives no rows.
    """
    model = fit(docs.filter(fold(id_col, folds) != held), id_col, text_col, lang_col)
    out = identify(docs, model, id_col, text_col)
    return out.select(id_col, F.coalesce(fold(id_col, folds) == held, F.lit(False)).alias("held_out"), "lang_pred", "score", "is_far")
