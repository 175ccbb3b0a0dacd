"""Word vectors and their means without the vocabulary in one place: skip-gram in parts, vectors sent to bundles of texts."""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from ..session import as_written, cut_lineage, is_written

# Workers get these functions with the task, whether or not the package is on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART_TOKENS = 2_000_000  # of a part of a fit, which holds the vectors of its own words only
BUNDLE_TOKENS = 1_000_000  # of the texts to which the vectors of their words are sent together
WINDOW = 5
NEGATIVES = 5  # words of other places for each pair of words
STEP, LAST_STEP = 0.025, 0.0001
_BLOCK = 1024
_SHARED = 64  # negatives drawn for a block, weighted to count as ``NEGATIVES`` per pair
_GATHERED = 1 << 16


def _lists(batches: list) -> tuple[pa.ChunkedArray, np.ndarray]:
    """The tokens of all lists, in order, and the length of each list; null tokens are left out."""
    columns = [column.filter(pc.is_valid(column)) for column in batches]
    flat, lengths = [], []
    for column in columns:
        tokens = column.flatten()
        rows = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False))
        valid = pc.is_valid(tokens).to_numpy(zero_copy_only=False)
        flat.append(tokens.filter(pa.array(valid)))
        lengths.append(np.bincount(rows[valid], minlength=len(column)))
    return pa.chunked_array(flat, pa.string()), np.concatenate([np.zeros(0, np.int64), *lengths])


def first_vectors(words: list[str], width: int, seed: int) -> np.ndarray:
    """Small vectors to begin with, the same for a word in every part."""
    table = np.random.default_rng(seed).random((4099, width), dtype=np.float32) - 0.5
    hashes = np.fromiter((zlib.crc32(word.encode("utf-8", "surrogatepass")) for word in words), np.int64, len(words))
    return (table[hashes % 4099] + table[hashes // 4099 % 4099]) / (2 * width)


def _sums(values: np.ndarray, order: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the rows of each word, damped where a word comes many times in a block."""
    return np.add.reduceat(values[order], starts, axis=0) / np.sqrt(counts)[:, None]


def skip_gram(codes: np.ndarray, lengths: np.ndarray, inner: np.ndarray, seed: int) -> np.ndarray:
    """One pass of skip-gram with negative sampling over lists of words, given as numbers of the rows of ``inner``."""
    random = np.random.default_rng(seed)
    outer = np.zeros_like(inner)
    lists = np.repeat(np.arange(len(lengths)), lengths)
    share = np.cumsum(np.bincount(codes, minlength=len(inner)) ** 0.75)
    for start in range(0, len(codes), _BLOCK):
        step = max(LAST_STEP, STEP * (1 - start / len(codes)))
        c, own = codes[start:start + _BLOCK], lists[start:start + _BLOCK]
        reach = random.integers(1, WINDOW + 1, len(c))
        e, o = inner[c], outer[c]
        to_e, to_o, pairs = np.zeros_like(e), np.zeros_like(o), np.zeros(len(c), np.float32)
        for apart in range(1, min(WINDOW + 1, len(c))):
            together = own[apart:] == own[:-apart]
            left, right = slice(None, -apart), slice(apart, None)
            for centre, context in ((left, right), (right, left)):
                met = (together & (reach[centre] >= apart)).astype(np.float32)
                miss = (met / (1 + np.exp((e[context] * o[centre]).sum(axis=1))))[:, None]
                to_e[context] += miss * o[centre]
                to_o[centre] += miss * e[context]
                pairs[context] += met
        drawn = np.searchsorted(share, random.random(_SHARED) * share[-1], "right")
        others = outer[drawn]
        miss = (pairs * (NEGATIVES / _SHARED))[:, None] / (1 + np.exp(-(e @ others.T)))
        to_e -= miss @ others
        order = np.argsort(c, kind="stable")
        words, starts, counts = np.unique(c[order], return_index=True, return_counts=True)
        inner[words] += step * _sums(to_e, order, starts, counts)
        outer[words] += step * _sums(to_o, order, starts, counts)
        np.add.at(outer, drawn, -step * (miss.T @ e) / math.sqrt(_BLOCK))
    return inner


def _fit_part(width: int, seed: int):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, lengths = _lists([batch.column(0) for batch in batches])
        if len(flat) == 0:
            return
        coded = flat.combine_chunks().dictionary_encode()
        words, codes = coded.dictionary, coded.indices.to_numpy()
        vectors = skip_gram(codes, lengths, first_vectors(words.to_pylist(), width, seed), seed)
        times = np.bincount(codes, minlength=len(words))
        for start in range(0, len(words), 10_000):
            some = vectors[start:start + 10_000]
            yield pa.RecordBatch.from_arrays([
                words[start:start + 10_000], pa.array(times[start:start + 10_000]),
                pa.FixedSizeListArray.from_arrays(pa.array(some.ravel().astype(np.float32)), width).cast(pa.list_(pa.float32())),
            ], ["token", "times", "vector"])

    return fit


def fit_in_parts(tokens: DataFrame, tokens_col: str, size: int, min_count: int, seed: int) -> DataFrame:
    """``token`` and ``vector`` of every word: texts are dealt to parts, whose vectors of a word are averaged.

    A part begins with the same small vectors and holds its own words; neither a task nor the driver holds all of them.
    Vectors are numbers of single precision, as MLlib's are.
    """
    lists = tokens.select(tokens_col)
    total = lists.agg(F.sum(F.greatest(F.size(tokens_col), F.lit(0)))).first()[0] or 0
    fitted = lists.repartition(max(1, math.ceil(total / PART_TOKENS))).mapInArrow(
        _fit_part(size, seed), "token string, times long, vector array<float>"
    )
    sums = [F.sum(F.col("vector")[k].cast("double")).alias(f"_s{k}") for k in range(size)]
    # dealt first: sums of one row each would only be wider
    words = fitted.repartition("token").groupBy("token").agg(F.sum("times").alias("times"), F.count("*").alias("_parts"), *sums)
    mean = F.array(*[(F.col(f"_s{k}") / F.col("_parts")).cast("float") for k in range(size)])
    fitted = cut_lineage(words.filter(F.col("times") >= min_count).select("token", mean.alias("vector")))
    return as_written(fitted.select("token", F.col("vector").cast("array<double>").alias("vector")))


def written_lists(df: DataFrame, tokens_col: str, glue: str) -> DataFrame:
    """``df``, written once with the tokens of a row as one text, a third as large; no token may be null, blank or hold ``glue``."""
    none = F.array().cast("array<string>")
    packed = cut_lineage(df.withColumn(tokens_col, F.array_join(tokens_col, glue)))
    lists = F.when(F.col(tokens_col) == "", none).otherwise(F.split(tokens_col, glue))
    return as_written(packed.withColumn(tokens_col, lists))


def bundles_of(rows: DataFrame, tokens_col: str, most: int, glue: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``rows`` dealt to bundles (``_bundle``) of about ``most`` tokens, and the distinct words of each (``_of``, ``token``).

    The rows are written once, unless they are already, so that both see a row in the same bundle; with ``glue`` as in
    ``written_lists``.
    """
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    if not is_written(rows):
        numbered = cut_lineage(numbered) if glue is None else written_lists(numbered, tokens_col, glue)
    total = numbered.agg(F.sum(F.greatest(F.size(tokens_col), F.lit(0)))).first()[0] or 0
    bundles = max(1, math.ceil(total / most))
    rows = numbered.withColumn("_bundle", F.pmod(F.xxhash64("_row"), F.lit(bundles)).cast("int")).drop("_row")
    dealt = rows.select("_bundle", tokens_col).repartition("_bundle")
    return rows, dealt.select(F.col("_bundle").alias("_of"), F.explode(tokens_col).alias("token")).distinct()


def vector_sums(
    df: DataFrame, key: str, tokens_col: str, vectors: DataFrame, width: int, glue: str | None = None
) -> DataFrame:
    """Per row its ``key``, ``_tokens`` (how many it has) and ``_sums``, the sum of the vectors of its tokens, written once.

    Texts are dealt to bundles, each word of a bundle is looked up once and its vector is sent there once, in single
    precision where that holds all of it.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(tokens_col).alias("_list"))
    rows, words = bundles_of(as_written(rows) if is_written(df) else rows, "_list", BUNDLE_TOKENS, glue)
    exact = F.every(F.forall("vector", lambda x: x.eqNullSafe(x.cast("float").cast("double"))))
    kind = "array<float>" if vectors.agg(exact).first()[0] else "array<double>"
    sent = words.join(vectors.select("token", F.col("vector").cast(kind).alias("vector")), "token")

    def pool(texts: pa.Table, found: pa.Table) -> pa.Table:
        flat, lengths = _lists([pc.coalesce(chunk, pa.scalar([], chunk.type)) for chunk in texts["_list"].chunks])
        vectors = found["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        known = np.concatenate([vectors, np.zeros((1, width), vectors.dtype)])  # the last row is that of unknown words
        codes = pc.index_in(flat.combine_chunks(), found["token"].combine_chunks()).fill_null(len(found)).to_numpy()
        sums, ends = np.zeros((len(lengths), width)), np.cumsum(lengths)
        at = 0
        while at < len(lengths):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _GATHERED, "right")))
            filled = at + np.flatnonzero(lengths[at:to])
            if len(filled):
                first = ends[at] - lengths[at]
                sums[filled] = np.add.reduceat(known[codes[first:ends[to - 1]]], (ends - lengths)[filled] - first, axis=0, dtype=np.float64)
            at = to
        return pa.table({
            "_key": texts["_key"], "_tokens": pa.array(lengths, pa.int64()),
            "_sums": pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), width).cast(pa.list_(pa.float64())),
        })

    kind = rows.schema["_key"].dataType.simpleString()
    pooled = rows.groupBy("_bundle").cogroup(sent.groupBy("_of")).applyInArrow(
        pool, f"_key {kind}, _tokens bigint, _sums array<double>"
    )
    return cut_lineage(pooled.withColumnRenamed("_key", key))  # so that what was sent for them can go


class SpreadWord2VecModel:
    """What ``Word2VecModel`` gives, for word vectors that are a table."""

    def __init__(self, vectors: DataFrame, tokens_col: str, name: str, size: int):
        self.vectors, self.tokens_col, self.name, self.size = vectors, tokens_col, name, size

    def getVectors(self) -> DataFrame:
        return self.vectors.select(F.col("token").alias("word"), array_to_vector("vector").alias("vector"))

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows with the mean of the vectors of their tokens; zeros for a row without a token."""
        keyed = as_written(cut_lineage(df).withColumn("_id", F.monotonically_increasing_id()))
        sums = vector_sums(keyed, "_id", self.tokens_col, self.vectors, self.size)
        tokens = F.greatest(F.col("_tokens"), F.lit(1))
        means = sums.select("_id", array_to_vector(F.transform("_sums", lambda x: x / tokens)).alias(self.name))
        return keyed.join(means, "_id").drop("_id")
