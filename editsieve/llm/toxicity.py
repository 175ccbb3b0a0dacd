"""Toxicity by classifier chains: categories are predicted one after another, each from the words and the earlier ones.

The chain is fitted on a bounded sample of labelled documents. Features are the beginnings of words, which inflected
forms share; those that tell a category best are kept. A later linear model gets the probabilities of the earlier
categories as features: out of fold while it is fitted, so that it learns from predictions of the quality it will meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from editsieve.llm import linear
from editsieve.llm.exchange import arrow_schema, extended
from editsieve.llm.pieces import slices
from editsieve.llm.words import LETTER_BYTES, mix, release_memory, split_words
from editsieve.session import cut_lineage

MAX_LABELLED = 20_000
FEATURES = 512
FOLDS = 3
PENALTY = 0.1
LEAST_DOCUMENTS = 5
_STARTS = (3, 4, 5, 6, 8)
_BATCH_BYTES = 1 << 20


def word_starts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash) of the beginnings of the words of each text; letters only, A-Z in lower case."""
    words = split_words(texts, LETTER_BYTES)
    length = words.end - words.start
    rows, keys = [], []
    for at in _STARTS:
        some = length >= at
        rows.append(words.row[some])
        keys.append(mix(words.upto(at).hashes(lower=True)[some], at))
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return row[new], key[new]


def _parts(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about a megabyte of text."""
    for batch in batches:
        for rows in slices(batch.column(text_col), _BATCH_BYTES):
            yield batch.slice(rows.start, rows.stop - rows.start)
        release_memory()


@dataclass
class Chain:
    """Sorted feature hashes and, for each category in order, weights (features, then earlier categories) and intercept."""

    categories: list[str]
    features: np.ndarray
    models: list[tuple[np.ndarray, float]]
    thresholds: list[float]

    def matrix(self, row: np.ndarray, key: np.ndarray, rows: int) -> linear.Sparse:
        if not len(self.features):
            return linear.Sparse(row[:0], row[:0], np.zeros(0), rows, 0)
        at = np.searchsorted(self.features, key).clip(max=len(self.features) - 1)
        known = self.features[at] == key
        return linear.Sparse(row[known], at[known], np.ones(known.sum()), rows, len(self.features))

    def probabilities(self, texts: pa.Array) -> list[np.ndarray]:
        row, key = word_starts(texts)
        x = self.matrix(row, key, len(texts))
        out: list[np.ndarray] = []
        for weights, intercept in self.models:
            more = np.column_stack([linear.logit(p) for p in out]) if out else np.zeros((len(texts), 0))
            out.append(linear.sigmoid(x.times(weights[: x.columns]) + more @ weights[x.columns :] + intercept))
        return out


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text",
    max_labelled: int = MAX_LABELLED, features: int = FEATURES,
) -> Chain:
    """The chain over 0/1 columns of ``labels``, in the order of ``categories``.

    The sample has at most ``max_labelled`` documents; of each only its entries among the chosen features reach the
    driver. A category is fitted on the documents that have its label, the others are predicted for the categories
    after it. Without labels every category has probability one half.
    """
    sample = linear.labelled(docs, labels, categories, id_col, text_col, max_labelled)
    chosen = _features(sample, categories, text_col, features)
    empty = Chain(categories, chosen, [], [])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, text_col):
            row, key = word_starts(batch.column(text_col))
            x = empty.matrix(row, key, batch.num_rows)
            counts = np.bincount(x.row, minlength=batch.num_rows)
            held = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(x.column, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *[batch.column(c).cast(pa.int32()) for c in categories], held], names=["id", *categories, "held"])

    ddl = "id long, " + "".join(f"`{c}` int, " for c in categories) + "held array<int>"
    rows = sample.select(id_col, text_col, *categories).mapInArrow(entries, ddl).collect()
    rows.sort(key=lambda r: (r["id"], r["held"]))
    ids = np.array([r["id"] for r in rows], np.int64)
    sizes = [len(r["held"]) for r in rows]
    column = np.array([c for r in rows for c in r["held"]], np.int64)
    x = linear.Sparse(np.repeat(np.arange(len(rows)), sizes), column, np.ones(len(column)), len(rows), len(chosen))
    fold = linear.folds(ids, FOLDS)
    earlier = np.zeros((len(rows), 0))
    models, thresholds = [], []
    for category in categories:
        y = np.array([r[category] for r in rows], float)
        known = ~np.isnan(y)
        whole = x.beside(earlier)
        models.append(linear.fit(whole.take(known), y[known], PENALTY))
        outside = np.zeros(len(rows))
        for k in range(FOLDS):
            used = known & (fold != k)
            weights, intercept = linear.fit(whole.take(used), y[used], PENALTY)
            outside[fold == k] = linear.sigmoid(whole.take(fold == k).times(weights) + intercept)
        thresholds.append(_threshold(outside[known], y[known]))
        earlier = np.column_stack([earlier, linear.logit(outside)])
    return Chain(categories, chosen, models, thresholds)


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Probability from which on the out-of-fold predictions have the best F1; of equal ones, that nearest one half."""
    best, at = -1.0, 0.5
    for t in np.arange(1, 20) / 20:
        hit = p >= t
        f1 = 2 * (hit & (y > 0)).sum() / max(1, hit.sum() + (y > 0).sum())
        if f1 > best + 1e-12 or abs(f1 - best) <= 1e-12 and abs(t - 0.5) < abs(at - 0.5):
            best, at = f1, float(t)
    return at


def _features(sample: DataFrame, categories: list[str], text_col: str, most: int) -> np.ndarray:
    """For each category the ``most`` word beginnings whose documents differ most between its classes."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, text_col):
            row, key = word_starts(batch.column(text_col))
            keys, at = np.unique(key, return_inverse=True)
            marks = [batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in categories]
            marks = [x for m in marks for x in (~np.isnan(m), np.nan_to_num(m))]  # labelled, and positive
            found = [np.bincount(at, m[row], len(keys)).astype(np.int64) for m in marks]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(np.bincount(at, minlength=len(keys))), *map(pa.array, found)],
                ["key", "n", *names],
            )

    names = [f"{kind}_{k}" for k in range(len(categories)) for kind in ("n", "p")]
    ddl = "key long, n long, " + ", ".join(f"{name} long" for name in names)
    totals = sample.agg(*[f(c).alias(f"{kind}_{k}") for k, c in enumerate(categories) for kind, f in (("n", F.count), ("p", F.sum))]).first()
    by_key = cut_lineage(
        sample.select(text_col, *categories).mapInArrow(counts, ddl).groupBy("key")
        .agg(F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in names]).filter(F.col("n") >= LEAST_DOCUMENTS)
    )
    chosen: set[int] = set()
    for k in range(len(categories)):
        positive = float(totals[f"p_{k}"] or 0)
        negative = float(totals[f"n_{k}"]) - positive
        if positive and negative:
            a, b = F.col(f"p_{k}"), F.col(f"n_{k}") - F.col(f"p_{k}")
            # the log odds ratio, less its uncertainty: a strong sign beats one that is only frequent
            ratio = F.abs(F.log((a + 0.5) / (positive + 1)) - F.log((b + 0.5) / (negative + 1)))
            gain = ratio - 1.64 * F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
            chosen.update(r["key"] for r in by_key.orderBy(gain.desc(), "key").limit(most).select("key").collect())
    return np.sort(np.array(sorted(chosen), np.int64).view(np.uint64))


def predict(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``docs`` with ``p_<category>`` and ``is_<category>``; whole texts, all rows. A null text has no words.

    Columns of these names are replaced, all others are kept.
    """
    added = [f"{kind}_{c}" for c in chain.categories for kind in ("p", "is")]
    docs = docs.drop(*added)
    schema = extended(docs.schema, ", ".join(f"`p_{c}` double, `is_{c}` boolean" for c in chain.categories))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = arrow_schema(schema)
        for part in _parts(batches, text_col):
            more = []
            for p, t in zip(chain.probabilities(part.column(text_col)), chain.thresholds, strict=True):
                more += [pa.array(p), pa.array(p >= t)]
            yield pa.RecordBatch.from_arrays([*part.columns, *more], schema=arrow)

    return docs.mapInArrow(each, schema)


CATEGORIES = ["poor", "toxic"]


def of_labels(labels: DataFrame) -> DataFrame:
    """The categories of the chain from a table of quality and toxicity marks."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("poor"), F.col("toxic"))
