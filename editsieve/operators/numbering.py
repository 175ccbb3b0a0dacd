"""Dense row numbers and running sums over a total order, without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, position below


def _as_columns(order_by) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def _partitioned_in_order(df: DataFrame, order_by, partitions: int | None) -> DataFrame:
    """Range-partitioned and sorted rows, each with its partition and place, written once.

    Written, because the range bounds are sampled: a second evaluation may cut elsewhere.
    """
    spark = df.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _as_columns(order_by)
    mark = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(count, *keys).sortWithinPartitions(*keys)
    return cut_lineage(ordered.withColumn("_mark", mark)).withColumns({
        "_part": F.shiftright("_mark", _POSITION_BITS),
        "_place": F.col("_mark").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
    }).drop("_mark")


def dense_id(
    df: DataFrame, order_by: list, name: str = "row_id", start: int = 0, partitions: int | None = None
) -> DataFrame:
    """Number the rows start, start+1, ... in the given order.

    Give a total order (end it with a unique column). One range shuffle; the offsets table has
    one row per partition, which bounds the broadcast.
    """
    marked = _partitioned_in_order(df, order_by, partitions)
    sizes = marked.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        marked.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place") + F.lit(start))
        .drop("_part", "_place", "_offset")
    )


def running_sum(
    df: DataFrame, value: str, order_by: list, name: str, partitions: int | None = None
) -> DataFrame:
    """Sum of ``value`` over all rows up to and including this one, in the given total order."""
    marked = _partitioned_in_order(df, order_by, partitions)
    sums = marked.groupBy("_part").agg(F.sum(value).alias("_part_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_part_sum").over(before), F.lit(0)).alias("_offset"))
    inside = (
        Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        marked.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.sum(value).over(inside))
        .drop("_part", "_place", "_offset")
    )


def ordered_split(
    df: DataFrame, order_by: list, share: float = 0.9, partitions: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """First rows up to index floor(share * n), counted from 0 and inclusive, and the rest."""
    numbered = dense_id(df, order_by, "_row_index", partitions=partitions)
    last = int(numbered.count() * share)
    first = numbered.filter(F.col("_row_index") <= last).drop("_row_index")
    rest = numbered.filter(F.col("_row_index") > last).drop("_row_index")
    return first, rest
