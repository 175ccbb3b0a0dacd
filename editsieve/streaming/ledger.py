"""Batches of a service that count: one file commits a batch, whatever was tried before.

A service writes the outputs of a batch into folders of this attempt only, then appends one file to the ledger. That
file names the attempt and carries the confusion counts of the batch per slide. It appears whole, so a batch either
counts with all its outputs or not at all; a batch that is repeated after it was committed is skipped. Live metrics are
a stream over the ledger's files and so count every batch once.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.evaluation import COUNTS, pane_confusion

SEGMENT = 1024  # batches whose files share a folder
LEDGER_DDL = (
    "owner string, batch bigint, attempt string, pane_start timestamp, true_positives bigint, "
    "false_positives bigint, false_negatives bigint, total_observations bigint"
)


def owner_of(batch: DataFrame) -> str:
    """Name of the query that a batch comes from: it stays with the checkpoint and changes with it."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def new_attempt() -> str:
    return uuid.uuid4().hex


def attempt_path(path: str, attempt: str) -> str:
    return f"{path}/attempt={attempt}"


class BatchLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(f"{LEDGER_DDL}, segment bigint").parquet(self.path).drop("segment")
        except AnalysisException:
            return self.spark.createDataFrame([], LEDGER_DDL)

    def holds(self, owner: str, batch: int) -> bool:
        """Whether the batch is committed; only the files of its segment are read."""
        try:
            rows = self.spark.read.schema(LEDGER_DDL).parquet(self._segment(batch))
        except AnalysisException:
            return False
        return not rows.filter((F.col("owner") == owner) & (F.col("batch") == batch)).isEmpty()

    def commit(self, scored: DataFrame, owner: str, batch: int, attempt: str) -> None:
        """Append the one file of a batch. A batch without rows has a row without counts."""
        name = [F.lit(owner).alias("owner"), F.lit(batch).cast("bigint").alias("batch"), F.lit(attempt).alias("attempt")]
        panes = pane_confusion(scored).select(*name, F.col("pane.start").alias("pane_start"), *COUNTS)
        none = self.spark.range(1).select(*name, F.lit(None).cast("timestamp").alias("pane_start"), *[F.lit(0).cast("bigint").alias(c) for c in COUNTS])
        panes.unionByName(none).coalesce(1).write.mode("append").parquet(self._segment(batch))

    def committed(self, path: str) -> DataFrame:
        """What the committed attempts wrote below ``path``; others are not seen."""
        attempts = self.rows().select("attempt").distinct()
        return self.spark.read.parquet(path).join(attempts, "attempt", "left_semi").drop("attempt")

    def panes(self) -> DataFrame:
        """The counts per slide as a stream; each file is read once."""
        stream = self.spark.readStream.schema(f"{LEDGER_DDL}, segment bigint").parquet(self.path)
        return stream.filter(F.col("pane_start").isNotNull()).select("pane_start", *COUNTS)

    def _segment(self, batch: int) -> str:
        return f"{self.path}/segment={batch // SEGMENT}"
