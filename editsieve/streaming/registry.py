"""Registry of accused accounts: an account counts for a while after its last accusation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.versions import is_done, newest_version, publish, read_version

# Fixed value: default time after which an accused account may write again.
FORGET_SECONDS = 24 * 3600

REGISTRY_DDL = "user string, last_accused timestamp"


def last_accusations(accused: DataFrame) -> DataFrame:
    """Per user the time of the last accusation (columns ``user``, ``timestamp`` in)."""
    return (
        accused.filter(F.col("user").isNotNull())
        .groupBy("user")
        .agg(F.max("timestamp").alias("last_accused"))
    )


def still_active(registry: DataFrame, forget_seconds: int) -> DataFrame:
    """Users accused within ``forget_seconds`` of the newest accusation; the boundary counts.

    Event time decides, so a replay gives the same registry. The newest time is one row.
    """
    newest = registry.agg(F.max("last_accused").alias("_newest")).first()[0]
    if newest is None:
        return registry
    limit = F.lit(newest) - F.make_dt_interval(secs=F.lit(forget_seconds))
    return registry.filter(F.col("last_accused") >= limit)


def active_accused(accused: DataFrame, forget_seconds: int = FORGET_SECONDS) -> DataFrame:
    return still_active(last_accusations(accused), forget_seconds)


def newest_registry(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole registry, or an empty one."""
    return read_version(spark, path, REGISTRY_DDL, newest_version(spark, path))


def merge_accusations(
    spark: SparkSession, path: str, accused: DataFrame, batch_id: int, forget_seconds: int, owner: str = "batch"
) -> DataFrame:
    """Merge one batch of accusations into the newest registry and return the accounts that count.

    A batch that ``owner`` has committed before changes nothing.
    """
    if not is_done(spark, path, owner, batch_id):
        known = newest_registry(spark, path)
        merged = (
            known.unionByName(last_accusations(accused).select("user", "last_accused"))
            .groupBy("user")
            .agg(F.max("last_accused").alias("last_accused"))
        )
        publish(still_active(merged, forget_seconds), path, owner=owner, batch=batch_id)
    return newest_registry(spark, path)
