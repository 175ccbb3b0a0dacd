"""Cleaning, sampling, shaping and enriching change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import hash_share
from ..functions.text import build_text
from ..schemas import CHECKED_CHANGE_SCHEMA, CORRUPT, ROUTING_SCHEMA
from ..session import cut_lineage
from .skew import lookup_join

# Fixed value: the monitoring domain that is always dropped.
MONITORING_DOMAIN = "canary"


def clean_raw_changes(
    df: DataFrame,
    server_name: str | None = None,
    action_type: str | None = None,
    value: str = "value",
) -> DataFrame:
    """Keep raw JSON events that parse, are no monitoring events and match the filters.

    Only the three routing fields are read; an event without them does not match and is dropped.
    """
    routing = F.from_json(
        F.col(value).cast("string"), ROUTING_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT}
    )
    # generated columns: a filter on a projected struct would parse the text once per condition
    routed = df.select("*", F.inline_outer(F.array(routing)).alias("_meta", "_server", "_type", CORRUPT))
    keep = F.col(value).isNotNull() & F.col(CORRUPT).isNull()
    keep &= F.col("_meta.domain") != MONITORING_DOMAIN
    if server_name is not None:
        keep &= F.col("_server") == server_name
    if action_type is not None:
        keep &= F.col("_type") == action_type
    return routed.filter(keep).select(*df.columns)


def star_expand(df: DataFrame, struct: str, *kept: str) -> DataFrame:
    """The fields of a struct column as columns, with the named columns beside them."""
    return df.select(f"{struct}.*", *kept)


def parse_envelope(df: DataFrame, keep_key: bool = False, observe: str | None = None) -> DataFrame:
    """Topic records to change events; records that are no valid event are dropped.

    With ``observe`` the numbers of records and of dropped records are reported as an
    observation of that name, without a second pass.
    """
    kept = ["key"] if keep_key else []
    change = F.from_json(
        F.col("value").cast("string"), CHECKED_CHANGE_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT}
    )
    # generated columns: each text is parsed once, whatever is filtered and selected later
    parsed = df.select(F.col("value").alias("_value"), F.inline_outer(F.array(change)), *kept)
    broken = F.col("_value").isNull() | F.col(CORRUPT).isNotNull()
    if observe is not None:
        parsed = parsed.observe(
            observe,
            F.count(F.lit(1)).alias("records"),
            F.count(F.when(broken, 1)).alias("dropped"),
        )
    return parsed.filter(~broken).drop("_value", CORRUPT)


def hash_sample(df: DataFrame, column: str, freq: float, hasher: str = "md5") -> DataFrame:
    """Keep the rows whose value hashes below ``freq``: all rows of a value, or none.

    A null value is dropped. Needs no shuffle, so a heavy value costs nothing extra.
    """
    if not 0 <= freq <= 1:
        raise ValueError(f"sampling frequency must be between 0 and 1: {freq}")
    return df.filter(hash_share(F.col(column), hasher) < F.lit(float(freq)))


def require_user(df: DataFrame) -> DataFrame:
    return df.filter(F.col("user").isNotNull())


def with_text(df: DataFrame, name: str = "text") -> DataFrame:
    return df.withColumn(name, build_text())


def label_from_flag(df: DataFrame, flag: str = "bot", name: str = "label") -> DataFrame:
    """1 where the flag is true, else 0 (also for null)."""
    return df.withColumn(name, F.coalesce(F.col(flag), F.lit(False)).cast("int"))


def confirmed_bots(df: DataFrame) -> DataFrame:
    """Accused-topic records as labelled users: ``value`` bytes to ``user``, label 1."""
    return value_as_user(df).withColumn("label", F.lit(1))


def value_as_user(df: DataFrame) -> DataFrame:
    return df.withColumn("user", F.col("value").cast("string"))


def keep_clean(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Events predicted as human, without the prediction."""
    return df.filter(F.col(prediction) == 0).drop(prediction)


def keep_accused(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """User names of events predicted as bot, one row per event, as ``value``."""
    return df.filter(F.col(prediction) == 1).select(F.col("user").alias("value"))


def repack_json(df: DataFrame, exclude: tuple[str, ...] = ("key", "timestamp")) -> DataFrame:
    """``key`` and the other columns as JSON ``value``; nulls are left out."""
    packed = [F.col(f"`{name}`") for name in df.columns if name not in exclude]
    value = F.to_json(F.struct(*packed)).alias("value")
    return df.select("key", value) if "key" in df.columns else df.select(value)


def rows_as_json(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(name))


def fill_missing(df: DataFrame, defaults: dict) -> DataFrame:
    return df.fillna(defaults)


def event_time(seconds: Column | str = "timestamp") -> Column:
    """Epoch seconds as a timestamp."""
    return F.timestamp_seconds(F.col(seconds) if isinstance(seconds, str) else seconds)


def with_event_time(df: DataFrame, name: str = "event_time") -> DataFrame:
    return df.withColumn(name, event_time())


def edits_per_minute(df: DataFrame) -> DataFrame:
    """Number of edits by minute and user: ``window``, ``user``, ``edits_per_minute``."""
    return df.groupBy(F.window(event_time(), "1 minute"), "user").agg(
        F.count(F.lit(1)).alias("edits_per_minute")
    )


def enrich_activity(df: DataFrame, **join_options) -> DataFrame:
    """Every edit with its user's number of edits in the same minute.

    Joined on minute and user, so each edit stays one row; an edit without user gets 0.
    """
    minute = F.floor(F.col("timestamp") / F.lit(60))
    edits = df.withColumn("_minute", minute)
    counts = (
        edits.filter(F.col("user").isNotNull())
        .groupBy("_minute", "user")
        .agg(F.count(F.lit(1)).alias("edits_per_minute"))
    )
    counts = cut_lineage(counts)
    row_counts = counts.withColumnRenamed("edits_per_minute", "_rows")
    joined = lookup_join(
        edits, counts, ["_minute", "user"], "left", row_counts, written=True, **join_options
    )
    return fill_missing(joined, {"edits_per_minute": 0}).select(*df.columns, "edits_per_minute")


def distinct_positive_users(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label") == 1).select("user").distinct()


def account_overlap(predicted: DataFrame, train: DataFrame, validation: DataFrame) -> DataFrame:
    """Counts of distinct accounts: flagged, training bots, validation bots and their overlaps.

    One row per account and role is grouped once, instead of three lists on the driver.
    """
    roles = (
        predicted.filter(F.col("prediction") == 1).select("user", F.lit("triggered").alias("role"))
        .unionByName(train.filter("bot").select("user", F.lit("train").alias("role")))
        .unionByName(validation.filter("bot").select("user", F.lit("validation").alias("role")))
    )

    def seen(role: str) -> Column:
        return F.max(F.col("role") == role).alias(role)

    accounts = roles.groupBy("user").agg(seen("triggered"), seen("train"), seen("validation"))

    def count(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    triggered, in_train, in_validation = F.col("triggered"), F.col("train"), F.col("validation")
    return accounts.agg(
        count(triggered, "triggered_users"),
        count(in_train, "train_bots"),
        count(in_validation, "validation_bots"),
        count(in_train & in_validation, "known_validation_bots"),
        count(in_validation & ~in_train, "new_validation_bots"),
        count(triggered & in_validation, "caught_bots"),
        count(triggered & ~in_validation, "wrongly_triggered"),
    )


def row_counts(**parts: DataFrame) -> DataFrame:
    """One row per named part with its number of rows."""
    counted = None
    for name, part in parts.items():
        one = part.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("part"), "rows")
        counted = one if counted is None else counted.unionByName(one)
    return counted
