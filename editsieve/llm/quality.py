"""Quality of documents: evidence of a classifier, combined with what is known of their host and path.

A linear classifier on the form of a text gives the likelihood ratio of a document. Summed up by host and by path
within the host, its probabilities give the rate of good documents there. Rates are shrunk: a host with few documents
towards the rate of all, a path towards its host, by as much as hosts (paths) are found to differ (empirical Bayes by
moments). The posterior of a document takes the shrunk rate of its path as its prior.
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
from editsieve.llm.words import release_memory, runs, split_words
from editsieve.session import cut_lineage

MAX_LABELLED = 20_000
BINS = 12
PENALTY = 0.5
KEEP_FROM = 0.5
_BATCH_BYTES = 1 << 20
_ASCII = np.arange(256)
_UPPER = (_ASCII >= 0x41) & (_ASCII < 0x5B)
_LOWER = (_ASCII >= 0x61) & (_ASCII < 0x7B)
_DIGIT = (_ASCII >= 0x30) & (_ASCII < 0x3A)
_STOP = np.isin(_ASCII, [ord(c) for c in ".,;:?'\"()-"])
_MARK = (_ASCII > 0x20) & (_ASCII < 0x7F) & ~(_UPPER | _LOWER | _DIGIT | _STOP)
_SPACE = _ASCII <= 0x20


def form(texts: pa.Array) -> np.ndarray:
    """Measures of the form of each text, one column each; a text without words has zeros."""
    words = split_words(texts)
    rows = len(words.offsets) - 1
    size = np.maximum(1, np.diff(words.offsets)).astype(float)

    def share(kind: np.ndarray, of: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(kind[words.data]))
        return (total[words.offsets[1:]] - total[words.offsets[:-1]]) / of

    spaces = share(_SPACE, size)
    dense = np.maximum(1, size * (1 - spaces))
    letters = np.maximum(1, (share(_UPPER, size) + share(_LOWER, size)) * size)
    hashes = words.hashes(lower=True)
    count = np.diff(words.first)
    many = np.maximum(1, count).astype(float)
    order = np.lexsort((hashes, words.row))
    key, row = hashes[order], words.row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    distinct = np.bincount(row[new], minlength=rows)
    begin = np.flatnonzero(new)
    times = np.diff(np.append(begin, len(key)))
    top = np.zeros(rows)
    np.maximum.at(top, row[begin], times)
    same = np.zeros(len(words), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.row[1:] == words.row[:-1])
    # a run of four words that came before in the text
    again = np.zeros(rows)
    if len(words) > 3:
        run, start = runs(hashes, words.row, 4)
        at = words.row[start]
        o = np.lexsort((run, at))
        repeated = np.zeros(len(run), bool)
        repeated[1:] = (run[o][1:] == run[o][:-1]) & (at[o][1:] == at[o][:-1])
        again = np.bincount(at[o][repeated], minlength=rows)
    return np.column_stack([
        share(_MARK, dense), share(_UPPER, letters), share(_DIGIT, dense), share(_STOP, dense), distinct / many,
        top / many, np.bincount(words.row[same], minlength=rows) / many, again / many,
        np.log1p(count), size / many, distinct / np.maximum(1, many**0.85),
    ])


@dataclass
class FormModel:
    """Quantile bins of each measure, and a weight for each bin."""

    edges: list[np.ndarray]
    weights: np.ndarray
    intercept: float

    def matrix(self, measures: np.ndarray) -> linear.Sparse:
        rows, count = measures.shape
        column = np.column_stack([
            np.searchsorted(edge, measures[:, k], "right") + k * (BINS + 1) for k, edge in enumerate(self.edges)
        ]) if rows else np.zeros((0, count), np.int64)
        return linear.Sparse(np.repeat(np.arange(rows), count), column.ravel(), np.ones(rows * count), rows, count * (BINS + 1))

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Logarithm of the odds that a text is good."""
        return self.matrix(form(texts)).times(self.weights) + self.intercept


def fit_form(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> tuple[FormModel, float]:
    """The classifier and the log odds of good documents in its sample of at most ``max_labelled`` labelled ones.

    Without labels there is no evidence: every document has even odds and is kept.
    """
    sample = linear.labelled(docs, labels, [label], id_col, text_col, max_labelled)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch.column(text_col), _BATCH_BYTES):
                part = batch.slice(rows.start, rows.stop - rows.start)
                values = form(part.column(text_col))
                held = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(id_col).cast(pa.int64()), part.column(label).cast(pa.int32()), held], ["id", "y", "held"])

    rows = sample.mapInArrow(measured, "id long, y int, held array<double>").collect()
    rows.sort(key=lambda r: (r["id"], r["held"]))
    width = len(form(pa.array([""]))[0])
    values = np.array([r["held"] for r in rows]).reshape(len(rows), width)
    y = np.array([r["y"] for r in rows], float)
    steps = np.arange(1, BINS) / BINS
    # quantiles of each class, so that a rare class is not lost in one bin
    edges = []
    for k in range(width):
        parts = [np.quantile(values[y == c, k], steps[::2]) for c in (0, 1) if (y == c).any()]
        edges.append(np.unique(np.concatenate(parts))[:BINS] if parts else np.zeros(0))
    model = FormModel(edges, np.zeros(width * (BINS + 1)), 0.0)
    if not len(rows):
        return model, 0.0
    model.weights, model.intercept = linear.fit(model.matrix(values), y, PENALTY)
    return model, float(linear.logit(np.array((y.sum() + 0.5) / (len(y) + 1))))


def with_evidence(docs: DataFrame, model: FormModel, text_col: str = "text", name: str = "_evidence") -> DataFrame:
    schema = extended(docs.schema, f"`{name}` double")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch.column(text_col), _BATCH_BYTES):
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.evidence(part.column(text_col)))], schema=arrow_schema(schema))
            release_memory()

    return docs.mapInArrow(each, schema)


def _shrink(sites: DataFrame, inner: list[str], parent: str) -> DataFrame:
    """``rate`` of each site, its own mean shrunk towards ``parent`` by the precision that the spread of sites shows."""
    mean = F.col("p") / F.col("n")
    sums = sites.agg(
        F.sum("n").alias("n"), F.count("*").alias("sites"), F.sum("p").alias("p"),
        F.sum(F.col("pp") - F.col("p") * mean).alias("within"), F.sum(F.col("n") * (mean - F.col(parent)) ** 2).alias("between"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
    ).first()
    n, count = sums["n"] or 0, sums["sites"] or 0
    if n <= count or count < 2:
        precision = 10.0
    else:
        rate = min(max(sums["p"] / n, 1e-6), 1 - 1e-6)
        noise = sums["within"] / (n - count)
        spread = max(1e-7, (sums["between"] - (count - 1) * noise) / max(1.0, n - sums["nn"] / n))
        precision = min(max(rate * (1 - rate) / spread - 1, 1.0), 1e6)
    return sites.select(*inner, "n", "p", "pp", ((F.col(parent) * precision + F.col("p")) / (precision + F.col("n"))).alias("rate"))


def score(
    docs: DataFrame, model: FormModel, prior: float, host_col: str = "source", path_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``quality_score``, the posterior probability of a good document, and ``is_good``.

    A null host or path is a site like any other. Columns of these names are replaced, all others are kept. The
    aggregates by host and path are grouped with partial sums, so a host with a third of all rows is no burden; they
    are joined back on host and path, and broadcast only where Spark finds them small.
    """
    docs = docs.drop("quality_score", "is_good", "_evidence", "_host", "_path", "_rate")
    host, path = F.coalesce(F.col(host_col).cast("string"), F.lit("")), F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    probability = 1 / (1 + F.exp(-F.col("_evidence")))
    seen = with_evidence(docs.select(host.alias("_host"), path.alias("_path"), text_col), model, text_col)
    paths = seen.groupBy("_host", "_path").agg(
        F.count("*").cast("double").alias("n"), F.sum(probability).alias("p"), F.sum(probability**2).alias("pp")
    )
    paths = cut_lineage(paths)
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("p").alias("p"), F.sum("pp").alias("pp"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("p").alias("p")).first()
    overall = (total["p"] / total["n"]) if total["n"] else 0.5
    hosts = _shrink(hosts.withColumn("overall", F.lit(float(overall))), ["_host"], "overall")
    paths = _shrink(paths.join(hosts.select("_host", F.col("rate").alias("host_rate")), "_host"), ["_host", "_path"], "host_rate")
    rate = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("_rate")))
    posterior = 1 / (1 + F.exp(-(F.col("_evidence") - prior + F.log(rate / (1 - rate)))))
    scored = with_evidence(docs.withColumns({"_host": host, "_path": path}), model, text_col)
    return (
        scored.join(paths.select("_host", "_path", F.col("rate").alias("_rate")), ["_host", "_path"])
        .withColumn("quality_score", posterior).withColumn("is_good", F.col("quality_score") >= KEEP_FROM)
        .select(*docs.columns, "quality_score", "is_good")
    )
