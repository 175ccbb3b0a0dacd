"""Joins of a large table to a keyed table that stay whole when one key holds many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import cut_lineage

BROADCAST_ROWS = 200_000
NARROW_ROWS = 1_000_000  # the same for tables of a key and one number or word
HOT_ROWS = 2_000_000
BROADCAST_BYTES = 128 << 20  # of values, whatever the number of rows
_ROW_BYTES = 16  # of a row besides its values


def value_bytes(column: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes; a null takes none."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        size = F.size(column) * 8
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(column, F.lit(0).cast("bigint"), lambda total, x: total + value_bytes(x, kind.elementType))
    elif isinstance(kind, T.StructType):
        size = sum((value_bytes(column.getField(f.name), f.dataType) for f in kind.fields), F.lit(0))
    elif isinstance(kind, T.MapType):
        return value_bytes(F.map_keys(column), T.ArrayType(kind.keyType)) + value_bytes(F.map_values(column), T.ArrayType(kind.valueType))
    elif isinstance(kind, T.UserDefinedType):
        size = F.octet_length(F.to_json(F.struct(column.alias("value"))))
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint"))


def fits(table: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``table`` is within both bounds; reads no more than one row beyond ``max_rows``."""
    size = sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in table.schema.fields), F.lit(_ROW_BYTES))
    sizes = table.select(size.alias("bytes"))  # so that only numbers go to the task that counts
    found = sizes.limit(max_rows + 1).agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).first()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "left",
    row_counts: DataFrame | None = None,
    written: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``rows`` to ``table`` (unique on ``on``); ``how`` is left, inner, left_semi or left_anti.

    The table is written once (unless it already is), measured, and broadcast if it is small in
    rows and in bytes. A larger one is joined in two parts: keys with more than ``hot_rows`` rows
    by broadcasting their table rows - by counting there are at most N / hot_rows such keys - if
    these are small too, and the rest by an ordinary shuffled join. ``row_counts`` (the keys and ``_rows``) saves counting the keys.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    if not written:
        table = cut_lineage(table)
    if fits(table, broadcast_rows):
        return rows.join(F.broadcast(table), on, how)
    has_key = F.lit(True)
    for key in on:
        has_key &= F.col(key).isNotNull()
    keyed = rows.filter(has_key)
    if row_counts is None:
        row_counts = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    hot_keys = cut_lineage(row_counts.filter(F.col("_rows") > hot_rows).select(*on))
    # measured as too large; Spark, which estimates a written table from the files below it, may think otherwise
    table = table.hint("merge")
    if hot_keys.isEmpty():
        joined = keyed.join(table, on, how)
    else:
        hot_table = cut_lineage(table.join(F.broadcast(hot_keys), on, "left_semi"))
        side = F.broadcast(hot_table) if fits(hot_table, broadcast_rows) else hot_table.hint("merge")
        hot = keyed.join(F.broadcast(hot_keys), on, "left_semi").join(side, on, how)
        joined = hot.unionByName(keyed.join(F.broadcast(hot_keys), on, "left_anti").join(table, on, how))
    if how in ("left", "left_anti"):  # a null key matches nothing, so it skips the shuffle
        joined = joined.unionByName(rows.filter(~has_key), allowMissingColumns=True)
    return joined
