"""Short texts to token lists and feature vectors."""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.feature import HashingTF, IDF, Word2Vec, Word2VecModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ..functions import text as ft
from ..session import cut_lineage
from .skew import NARROW_ROWS, fits, lookup_join
from .wordvectors import BUNDLE_TOKENS, SpreadWord2VecModel, bundles_of, fit_in_parts, written_lists

# Workers get these functions with the task, whether or not the package is on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: width of the feature vectors.
VECTOR_SIZE = 64
METHODS = ("word2vec", "tfidf", "tfidf_md5")

# Lists up to this length become a hash set inside the expression.
INLINE_WORDS = 20_000
SEED = 7
STEM_BYTES = 48 << 20  # of stems that every task holds
TEXTS_PER_PART = 250  # texts that a part of a fit of word vectors has at least
DRIVER_WORDS = 100_000  # words, by estimate, whose vectors MLlib fits on the driver; more are fitted in parts that hold their own


def positions(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """``id_col``, ``pos`` and ``token`` of every token."""
    # outer, because a plain explode also filters on the size of the list, which computes it twice
    placed = df.select(id_col, F.posexplode_outer(tokens_col).alias("pos", "token"))
    return placed.filter(F.col("token").isNotNull())


def token_rows(df: DataFrame, tokens_col: str, name: str = "token", *kept: str) -> DataFrame:
    """One row per token, with the columns ``kept``."""
    spread = df.select(*kept, F.explode_outer(tokens_col).alias(name))
    return spread.filter(F.col(name).isNotNull())


def gather(tokens: DataFrame, id_col: str, value: str, name: str) -> DataFrame:
    """Token lists back from positions, in order."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", value)))
    return tokens.groupBy(id_col).agg(F.transform(ordered, lambda item: item[value]).alias(name))


def with_row_key(df: DataFrame) -> DataFrame:
    """``df``, written once, with a key ``_row`` of each row: ids may be null or repeated."""
    return cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))


def remove_noise(
    df: DataFrame, tokens_col: str, stopwords: DataFrame | None = None, id_col: str = "id"
) -> DataFrame:
    """Drop blank tokens and stopwords (column ``word``) from a token list.

    A list of checked length is tested inside the row; a longer one is an anti join on tokens. Either way each row keeps
    its own tokens, whatever its ``id_col``, and null words do not count.
    """
    bare = df.withColumn(tokens_col, ft.without_blanks(F.col(tokens_col)))
    if stopwords is None:
        return bare
    stopwords = stopwords.select("word").filter(F.col("word").isNotNull())
    words = [row["word"] for row in stopwords.limit(INLINE_WORDS + 1).collect()]
    if len(words) <= INLINE_WORDS:
        return bare.withColumn(tokens_col, ft.without_words(F.col(tokens_col), words))
    listed = stopwords.select(F.col("word").alias("token")).distinct()
    bare = with_row_key(bare)
    kept = lookup_join(positions(bare, "_row", tokens_col), listed, ["token"], "left_anti")
    gathered = gather(kept, "_row", "token", "_kept")
    none = F.when(F.col(tokens_col).isNotNull(), F.array().cast("array<string>"))
    return bare.join(gathered, "_row", "left").withColumn(tokens_col, F.coalesce("_kept", none)).drop("_kept", "_row")


def stem_tokens(
    df: DataFrame, tokens_col: str, stems: DataFrame | None, id_col: str = "id"
) -> DataFrame:
    """Replace tokens by their stems (columns ``token``, ``stem``, one row of each token); others keep themselves.

    Stems that fit are sent to every task, and no row moves. Of many, those of the words of a bundle of texts are
    sent to it. Each row keeps its own tokens, whatever its ``id_col``; null tokens are left out.
    """
    if stems is None:
        return df
    stems = cut_lineage(stems.select("token", "stem").filter(F.col("token").isNotNull() & F.col("stem").isNotNull()))
    if fits(stems, NARROW_ROWS, STEM_BYTES):
        held = stems.sparkSession.sparkContext.broadcast(_packed(stems.toArrow()))
        return df.mapInArrow(_stemming(held, tokens_col), df.schema)
    rows, words = bundles_of(df, tokens_col, BUNDLE_TOKENS)
    sent = words.join(stems, "token")

    def stem(texts: pa.Table, found: pa.Table) -> pa.Table:
        lookup = _column(found["token"]), _column(found["stem"])
        at = texts.schema.get_field_index(tokens_col)
        stemmed = pa.chunked_array([_stemmed(chunk, *lookup) for chunk in texts[tokens_col].chunks], texts.schema.field(at).type)
        return texts.set_column(at, texts.schema.field(at), stemmed).drop_columns(["_bundle"])

    return rows.groupBy("_bundle").cogroup(sent.groupBy("_of")).applyInArrow(stem, df.schema)


def _column(values: pa.ChunkedArray) -> pa.Array:
    return values.cast(pa.string()).combine_chunks() if values.num_chunks else pa.array([], pa.string())


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _stemming(held, tokens_col: str):
    def stem(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.ipc.open_stream(held.value).read_all()
        lookup = _column(table["token"]), _column(table["stem"])
        for batch in batches:
            at = batch.schema.get_field_index(tokens_col)
            yield batch.set_column(at, batch.schema.field(at), _stemmed(batch.column(at), *lookup))

    return stem


def _stemmed(lists: pa.Array, known: pa.Array, stems: pa.Array) -> pa.Array:
    """The lists with known tokens replaced; distinct tokens are looked up."""
    values = lists.flatten()
    valid = pc.is_valid(values).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    ends = np.r_[0, np.cumsum(np.bincount(rows[valid], minlength=len(lists)))].astype(np.int32)
    coded = values.filter(pa.array(valid)).cast(pa.string()).dictionary_encode()
    words = coded.dictionary
    place = pc.index_in(words, known)
    out = pc.coalesce(stems.take(place), words).take(coded.indices)
    return pa.ListArray.from_arrays(pa.array(ends), out, mask=pc.is_null(lists)).cast(lists.type)


def drop_empty(df: DataFrame, tokens_col: str) -> DataFrame:
    return df.filter(F.size(tokens_col) > 0)


def clean_tokens(
    df: DataFrame, text_col: str, name: str = "tokens", stopwords: DataFrame | None = None,
    stems: DataFrame | None = None, id_col: str = "id", columns: list[str] | None = None,
) -> DataFrame:
    """Letters only, lower case, split, without noise, stemmed; texts left empty are dropped.

    All columns are kept, or only ``columns`` and the tokens: texts that nobody reads need not travel with them.
    """
    split = df.withColumn(name, ft.letter_tokens(F.col(text_col)))
    if columns is not None:
        split = split.select(*dict.fromkeys([*columns, name]))
    return drop_empty(stem_tokens(remove_noise(split, name, stopwords, id_col), name, stems, id_col), name)


def tfidf_features(
    df: DataFrame, tokens_col: str = "tokens", name: str = "features", size: int = VECTOR_SIZE,
    columns: list[str] | None = None,
) -> DataFrame:
    """Hashed term counts weighted by inverse document frequency, as a vector of ``size``; all columns are kept, or ``columns``."""
    counted = HashingTF(inputCol=tokens_col, outputCol="_counts", numFeatures=size).transform(df)
    # read by the fit and again for the weights
    counted = cut_lineage(counted if columns is None else counted.select(*columns, "_counts"))
    model = IDF(inputCol="_counts", outputCol=name).fit(counted)
    return model.transform(counted).drop("_counts")


def tfidf_md5_features(
    df: DataFrame, tokens_col: str = "tokens", name: str = "features", size: int = VECTOR_SIZE,
    columns: list[str] | None = None,
) -> DataFrame:
    """The same with md5 as the hash of a token, which any engine can repeat: an array of ``size``.

    A token counts at the number of the first eight hexadecimal digits of its md5 modulo ``size``;
    the weight of a place is its count times ln((n + 1) / (m + 1)) for n texts, m of which have
    the place. Tokens are counted where their text lies; no text moves.
    """
    counted = df.mapInArrow(
        _places(tokens_col, size), StructType([*df.schema.fields, StructField("_counts", ArrayType(LongType()))])
    )
    # read for the total, for the weights, and by each use
    counted = cut_lineage(counted if columns is None else counted.select(*columns, "_counts"))
    seen = [F.count_if(F.col("_counts")[k] > 0).alias(f"m{k}") for k in range(size)]
    total, *seen = counted.agg(F.count("*").alias("n"), *seen).first()
    weights = F.array(*[F.lit(math.log((total + 1) / (m + 1))) for m in seen])
    return counted.withColumn(name, F.zip_with("_counts", weights, lambda tf, weight: tf * weight)).drop("_counts")


def _places(tokens_col: str, size: int):
    """Adds how many tokens of a row have each place by their md5."""

    def place_of(token: str) -> int:
        return int(hashlib.md5(token.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16) % size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(tokens_col)
            values = lists.flatten()
            valid = pc.is_valid(values).to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))[valid]
            coded = values.filter(pa.array(valid)).dictionary_encode()
            places = np.fromiter(map(place_of, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
            counts = np.bincount(rows * size + places[coded.indices.to_numpy()], minlength=len(lists) * size).astype(np.int64)
            ends = pa.array(np.arange(len(lists) + 1, dtype=np.int32) * size)
            yield batch.append_column(pa.field("_counts", pa.list_(pa.int64())), pa.ListArray.from_arrays(ends, pa.array(counts)))

    return count


def tfidf_terms(df: DataFrame, id_col: str, tokens_col: str = "tokens") -> DataFrame:
    """The unhashed twin: ``id_col``, ``term``, ``tf``, ``df``, ``tfidf`` of every term of a text.

    Texts, not their terms, are dealt out by id to be counted. The terms that most rows have are
    joined by broadcast: if ``NARROW_ROWS`` terms shared the rows evenly, each would have
    ``hot_rows``, so no more terms than that have more. Texts without a token do not count.
    """
    counts = cut_lineage(
        token_rows(df.select(id_col, tokens_col).repartition(id_col), tokens_col, "term", id_col)
        .groupBy(id_col, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    total = counts.select(id_col).distinct().count()
    frequencies = cut_lineage(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    weight = F.log(F.lit(total + 1.0) / (F.col("df") + 1))
    rows = frequencies.agg(F.sum("df")).first()[0] or 0
    joined = lookup_join(
        counts, frequencies, ["term"], "inner", frequencies.withColumnRenamed("df", "_rows"),
        written=True, broadcast_rows=NARROW_ROWS, hot_rows=max(1, rows // NARROW_ROWS),
    )
    return joined.withColumn("tfidf", F.col("tf") * weight)


def fit_word2vec(
    df: DataFrame, tokens_col: str = "tokens", name: str = "features", size: int = VECTOR_SIZE,
    min_count: int = 0, seed: int = SEED, partitions: int | None = None,
) -> Word2VecModel | SpreadWord2VecModel:
    """Word vectors, fitted in parts that are averaged: as many as there are cores, but each of enough texts.

    With ``partitions=1`` a seed gives the same vectors whatever the rows' partitions. MLlib holds
    the vocabulary on the driver. More than ``DRIVER_WORDS`` words are fitted by skip-gram with
    negative sampling in parts of a bounded number of tokens, and stay a table.
    """
    words = df.select(F.explode(tokens_col).alias("word")).agg(F.approx_count_distinct("word")).first()[0]
    if words > DRIVER_WORDS:
        return SpreadWord2VecModel(fit_in_parts(df, tokens_col, size, min_count, seed), tokens_col, name, size)
    if partitions is None:
        cores = df.sparkSession.sparkContext.defaultParallelism
        partitions = max(1, min(cores, df.count() // TEXTS_PER_PART))
    return Word2Vec(
        inputCol=tokens_col, outputCol=name, vectorSize=size, minCount=min_count, seed=seed,
        numPartitions=partitions,
    ).fit(df)


def add_features(
    df: DataFrame, text_col: str, name: str = "features", method: str = "word2vec",
    stopwords: DataFrame | None = None, stems: DataFrame | None = None, id_col: str = "id",
    size: int = VECTOR_SIZE, seed: int = SEED, min_count: int = 0, partitions: int | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Texts with a feature vector; texts without a token are dropped.

    All columns and the tokens are kept, or only ``columns``.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    tokens = clean_tokens(df, text_col, "tokens", stopwords, stems, id_col, columns)
    if method == "tfidf":
        featured = tfidf_features(tokens, "tokens", name, size, columns)
    elif method == "tfidf_md5":
        featured = tfidf_md5_features(tokens, "tokens", name, size, columns)
    else:
        # read by the fit, and again by each use of the vectors; without stems tokens are letters
        tokens = written_lists(tokens, "tokens", " ") if stems is None else cut_lineage(tokens)
        featured = fit_word2vec(tokens, "tokens", name, size, min_count, seed, partitions).transform(tokens)
    return featured if columns is None else featured.select(*columns, name)
