"""Distances and overlaps of array columns, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def euclidean_distance(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y))))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cos; 0 where a norm is zero, 2 where an input is no vector."""
    lengths = norm(a) * norm(b)
    return (
        F.when(a.isNull() | b.isNull(), F.lit(2.0))
        .when(lengths == 0, F.lit(0.0))
        .otherwise(F.lit(1.0) - dot(a, b) / lengths)
    )


def mean_vector(vectors: Column, width: int) -> Column:
    """Element-wise mean of an array of vectors; null when it is empty."""
    zero = F.array_repeat(F.lit(0.0), width)
    total = F.aggregate(
        vectors, zero, lambda acc, v: F.zip_with(acc, as_doubles(v), lambda x, y: x + y)
    )
    return F.when(F.size(vectors) > 0, F.transform(total, lambda x: x / F.size(vectors)))


def iou(real: Column, predicted: Column) -> Column:
    """Overlap of two id lists: 1 without a truth, 0 without a prediction."""
    together = F.size(F.array_union(real, predicted))
    return (
        F.when(real.isNull(), F.lit(1.0))
        .when(predicted.isNull(), F.lit(0.0))
        .when(together == 0, F.lit(1.0))
        .otherwise(F.size(F.array_intersect(real, predicted)) / together)
    )
