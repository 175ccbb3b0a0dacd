"""Confusion counts, derived metrics, selection score, class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.metrics import confusion_flag_columns, guarded_ratio, harmonic_mean
from .changes import event_time

# Window of the live metrics, bonus and floor of the selection score.
WINDOW_SECONDS = 600
SLIDE_SECONDS = 300
PRECISION_BONUS = 0.2
PRECISION_FLOOR = 0.95

COUNTS = ("true_positives", "false_positives", "false_negatives", "total_observations")


def confusion_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(confusion_flag_columns())


def _count_aggregates() -> list[Column]:
    flagged = [F.coalesce(F.sum(flag), F.lit(0)) for flag in ("tp", "fp", "fn")]
    return [column.cast("bigint").alias(name) for column, name in zip([*flagged, F.count("*")], COUNTS, strict=True)]


def pane_confusion(df: DataFrame, slide_seconds: int = SLIDE_SECONDS, time: Column | None = None) -> DataFrame:
    """Confusion counts per slide (``pane``): what sliding windows are summed from."""
    stamped = confusion_flags(df).withColumn("event_time", event_time() if time is None else time)
    return stamped.groupBy(F.window("event_time", f"{slide_seconds} seconds").alias("pane")).agg(*_count_aggregates())


def windows_of_panes(
    panes: DataFrame, window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS
) -> DataFrame:
    """Sliding windows summed from counts per slide (``pane_start``), in batch or on a stream."""
    window = F.window("pane_start", f"{window_seconds} seconds", f"{slide_seconds} seconds").alias("window")
    grouped = panes.groupBy(window).agg(*[F.sum(name).alias(name) for name in COUNTS])
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *COUNTS)


def windowed_confusion(
    df: DataFrame,
    window_seconds: int = WINDOW_SECONDS,
    slide_seconds: int = SLIDE_SECONDS,
    time: Column | None = None,
) -> DataFrame:
    """Confusion counts per sliding window: ``window_start``, ``window_end`` and four counts.

    In batch the rows are first summed per slide, then each slide's sums go to the windows that
    cover it, so the rows themselves are never multiplied. A stream uses ``window`` directly.
    """
    if df.isStreaming or window_seconds % slide_seconds:
        stamped = confusion_flags(df).withColumn("event_time", event_time() if time is None else time)
        grouped = stamped.groupBy(
            F.window("event_time", f"{window_seconds} seconds", f"{slide_seconds} seconds")
        ).agg(*_count_aggregates())
    else:
        panes = pane_confusion(df, slide_seconds, time)
        spread = panes.withColumn("back", F.explode(F.sequence(
            F.lit(0), F.lit(window_seconds - slide_seconds), F.lit(slide_seconds)
        )))
        start = F.timestamp_seconds(F.unix_seconds("pane.start") - F.col("back"))
        end = F.timestamp_seconds(F.unix_seconds("pane.start") - F.col("back") + window_seconds)
        grouped = spread.groupBy(F.struct(start.alias("start"), end.alias("end")).alias("window")).agg(
            *[F.sum(name).alias(name) for name in COUNTS]
        )
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *COUNTS
    )


def first_flag_by_window(
    df: DataFrame, window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS
) -> DataFrame:
    """The ``bot`` flag of the earliest event (lowest time, then id) of each sliding window."""
    window = F.window(event_time(), f"{window_seconds} seconds", f"{slide_seconds} seconds")
    first = F.min_by("bot", F.struct("timestamp", "id")).alias("bots")
    grouped = df.groupBy(window.alias("window")).agg(first)
    return grouped.select(F.col("window.start").alias("window_start"), "bots")


def global_confusion(df: DataFrame) -> DataFrame:
    """Confusion counts of all rows, one row (zeros for no rows)."""
    counted = confusion_flags(df).agg(*_count_aggregates())
    return counted.select(*[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in COUNTS])


def derive_metrics(counts: DataFrame, empty: float = 1.0) -> DataFrame:
    """Accuracy, precision, recall and F1 from the four counts.

    ``empty`` stands in for precision and recall of nothing: 1 in live metrics, 0 in model
    selection. Accuracy of no rows is 1.
    """
    tp, fp, fn, total = (F.col(name) for name in COUNTS)
    return (
        counts.withColumn("accuracy", guarded_ratio(total - fp - fn, total, 1.0))
        .withColumn("precision", guarded_ratio(tp, tp + fp, empty))
        .withColumn("recall", guarded_ratio(tp, tp + fn, empty))
        .withColumn("f1_score", harmonic_mean(F.col("precision"), F.col("recall")))
    )


def f1_with_precision_floor(metrics: DataFrame, floor: float = PRECISION_FLOOR) -> DataFrame:
    """Selection score: F1, and a bonus once precision reaches the floor."""
    bonus = F.when(F.col("precision") >= floor, F.lit(PRECISION_BONUS)).otherwise(F.lit(0.0))
    return metrics.withColumn("score", F.col("f1_score") + bonus)


def validation_report(df: DataFrame) -> DataFrame:
    """One-row report of a model's predictions against ``bot``."""
    return derive_metrics(global_confusion(df), empty=0.0)


def class_weight_table(df: DataFrame, mode: str | None = None, label: str = "label") -> DataFrame:
    """``label`` and ``weight``: 1, total / (classes * count), or its square root."""
    if mode not in (None, "balanced", "sqrt"):
        raise ValueError(f"weights must be None, 'balanced' or 'sqrt', not {mode!r}")
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_rows"))
    if mode is None:
        return counts.select(label, F.lit(1.0).alias("weight"))
    totals = counts.agg(F.sum("_rows").alias("total"), F.count(F.lit(1)).alias("classes")).first()
    ratio = F.lit(totals["total"]) / (F.lit(totals["classes"]) * F.col("_rows"))
    return counts.select(label, (ratio if mode == "balanced" else F.sqrt(ratio)).alias("weight"))


def class_weights(df: DataFrame, mode: str | None = None, label: str = "label") -> DataFrame:
    """Every row with the weight of its class; the two-class table has a proven size."""
    if mode is None:
        return df.withColumn("weight", F.lit(1.0))
    table = class_weight_table(df, mode, label)
    # the label is 0 or 1, so this is two rows
    weights = {row[label]: row["weight"] for row in table.filter(F.col(label).isin(0, 1)).collect()}
    one, zero = F.lit(weights.get(1, 1.0)), F.lit(weights.get(0, 1.0))
    return df.withColumn("weight", F.when(F.col(label) == 1, one).otherwise(zero))
