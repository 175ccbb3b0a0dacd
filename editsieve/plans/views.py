"""The driver's tables in the shapes the operators read, in Spark and in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Training bots are taken from events before this time, the rest is looked up.
SPLIT_TIME = "2024-01-16 00:00:00"
SPLIT_SECONDS = 1_705_363_200  # the same in UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where there are fewer files than cores; else as they were read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def changes(spark: SparkSession, sf_dir: str, part: str | None = None) -> DataFrame:
    """``events`` as change events; ``part`` is ``train`` (before the split) or ``validation``.

    The split is a condition on the stored column, so that it reaches the scan.
    """
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    split = F.to_timestamp_ntz(F.lit(SPLIT_TIME))
    rows = table(spark, sf_dir, "events")
    if part is not None:
        rows = rows.filter(F.col("ts") < split if part == "train" else F.col("ts") >= split)
    return rows.select(
        F.col("event_id").alias("id"),
        F.timestamp_diff("SECOND", epoch, F.col("ts")).alias("timestamp"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"),
        (F.col("user_id") % 10 == 0).alias("bot"),
        F.col("event_type").alias("type"),
        F.col("event_type").alias("title"),
        F.when(F.col("event_id") % 7 != 0, F.col("props")).alias("comment"),
        F.when(F.col("event_id") % 3 == 0, "a.example").otherwise("b.example").alias("server_name"),
        F.when(F.col("event_id") % 50 == 0, '{"domain":"canary"}')
        .otherwise('{"domain":"x"}').alias("meta"),
    )


CHANGES_SQL = """
ch AS (
  SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
    'u' || CAST(user_id AS VARCHAR) AS "user", user_id % 10 = 0 AS bot,
    event_type AS type, event_type AS title,
    CASE WHEN event_id % 7 <> 0 THEN props END AS comment,
    CASE WHEN event_id % 3 = 0 THEN 'a.example' ELSE 'b.example' END AS server_name,
    CASE WHEN event_id % 50 = 0 THEN '{"domain":"canary"}' ELSE '{"domain":"x"}' END AS meta
  FROM events
)"""


def with_changes(sql: str) -> str:
    """A statement over ``ch``; further common tables may follow directly."""
    return f"WITH {CHANGES_SQL.strip()}{sql}"


def md5_sql(text: str, digits: int = 8) -> str:
    return f"CAST(('0x' || substr(md5({text}), 1, {digits})) AS BIGINT)"

