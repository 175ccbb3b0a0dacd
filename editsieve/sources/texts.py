"""Listings, articles and stopword lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.numbering import dense_id
from ..schemas import ARTICLES_SCHEMA
from .recorded import scan_quoted_csv


def first_rows(df: DataFrame, n: int, order_by: str = "id") -> DataFrame:
    """The first ``n`` rows by ``order_by``; all of them when ``n`` is not positive."""
    return df.orderBy(order_by).limit(n) if n > 0 else df


def clean_listings(df: DataFrame, n: int = 0) -> DataFrame:
    """One row per name, numbered 0, 1, ... in id order; rows without id or name are dropped.

    The lowest id of a name is kept, found before the shuffle by partial aggregation.
    """
    named = first_rows(df, n).select("id", "name").dropna()
    kept = named.groupBy("name").agg(F.min("id").alias("_listing_id"))
    return dense_id(kept, ["_listing_id"], "id").select("id", "name")


def load_listings(spark: SparkSession, path: str, n: int = 0) -> DataFrame:
    return clean_listings(scan_quoted_csv(spark, path), n)


def articles_from_json(df: DataFrame) -> DataFrame:
    """Rows of the articles nested in the first item of each response (column ``items``)."""
    return df.select(F.inline(F.col("items")[0]["articles"]))


def load_articles(spark: SparkSession, path: str) -> DataFrame:
    return articles_from_json(spark.read.schema(ARTICLES_SCHEMA).json(path, multiLine=True))


def load_stopwords(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Distinct words of several lists, one word per line."""
    return union_stopwords(*[
        spark.read.text(path).select(F.col("value").alias("word")) for path in paths
    ])


def union_stopwords(*lists: DataFrame) -> DataFrame:
    united = lists[0].select("word")
    for words in lists[1:]:
        united = united.unionByName(words.select("word"))
    trimmed = united.select(F.trim("word").alias("word"))
    return trimmed.filter(F.col("word") != "").distinct()
