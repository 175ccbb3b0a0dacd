"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Stages take (spark, docs, sf_dir) and give the columns of ``documents``, the last one the packed pieces. A stage works
on all that its predecessor kept and its decisions take effect:

1. quality: documents that the classifier rejects go (labels of the input that are still there train it);
2. toxicity: documents that the chain calls toxic go;
3. near_duplicates: of each class of linked documents the one with the smallest id stays (of equal ids one row, a null
   id last); rows are told apart by their place, so documents that share an id may go different ways;
4. repeated_passages: words in windows that also start in an earlier document go; ``n_chars`` follows the text;
5. packing: the documents become pieces of sequences.

A document with a null text has no words: the first stages judge it like any other, the third links it with nothing
and keeps it, the fourth gives it an empty text. The stages on trained models cannot be said in SQL, so ``ORACLE_SQL`` is None, and
``tests/llm`` checks each stage against a brute-force version.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from editsieve.llm import jaccard, packing, quality, substrings, toxicity
from editsieve.llm.queries import ORACLES as LLM_ORACLES, QUERIES as LLM_QUERIES
from editsieve.session import shared_dir

__all__ = ["LLM_ORACLES", "LLM_QUERIES", "ORACLE_SQL", "STAGES", "run"]

ORACLE_SQL = None
# Half of what the operator takes by itself, as executors hold the memory of earlier stages too.
CHUNK_BYTES = 4 << 20


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model, prior = quality.fit_form(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, prior).filter("is_good").select(*docs.columns)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = toxicity.of_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    chain = toxicity.fit_chain(docs, labels, toxicity.CATEGORIES)
    return toxicity.predict(docs, chain).filter("NOT is_toxic").select(*docs.columns)


def keep_first_of_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    del spark, sf_dir
    return jaccard.first_of_classes(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    del spark, sf_dir
    kept = substrings.remove_repeated(docs, chunk_bytes=CHUNK_BYTES)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    del spark, sf_dir
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", keep_good),
    ("toxicity", keep_civil),
    ("near_duplicates", keep_first_of_class),
    ("repeated_passages", without_repeated_passages),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, with a written table between each two."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4()}"
    for number, (name, stage) in enumerate(STAGES[:-1], 1):
        out = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)


LLM_QUERIES = {**LLM_QUERIES, "pipeline": run}
if ORACLE_SQL is not None:
    LLM_ORACLES = {**LLM_ORACLES, "pipeline": ORACLE_SQL}
