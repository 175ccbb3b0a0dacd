"""Confusion flags and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def confusion_flag_columns(actual: str = "bot", predicted: str = "prediction") -> dict[str, Column]:
    """0/1 columns tp, fp, fn; a null ``actual`` counts in none of them."""
    flagged = F.col(predicted) == 1
    passed = F.col(predicted) == 0
    is_bot = F.col(actual)

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("int")

    return {"tp": flag(is_bot & flagged), "fp": flag(~is_bot & flagged), "fn": flag(is_bot & passed)}


def guarded_ratio(part: Column, whole: Column, empty: float) -> Column:
    """``part / whole``, or ``empty`` where the whole is zero."""
    return F.when(whole == 0, F.lit(float(empty))).otherwise(part / whole)


def harmonic_mean(a: Column, b: Column) -> Column:
    return F.when((a == 0) & (b == 0), F.lit(0.0)).otherwise(F.lit(2.0) * a * b / (a + b))
