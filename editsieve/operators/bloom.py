"""Bloom filter as tables: one row of parameters and 64-bit words of set bits."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.hashing import HASHERS, seeded_position
from ..session import cut_lineage
from ..sources import versions
from .changes import distinct_positive_users
from .skew import lookup_join

WORD_BITS = 64
DEFAULT_FPR = 0.1
# Words up to this many rows (64 Mbit) are broadcast for a per-row test.
BROADCAST_WORDS = 1_000_000


@dataclass(frozen=True)
class BloomParams:
    size: int
    hash_count: int
    capacity: int
    false_positive_rate: float
    inserted_count: int = 0
    hasher: str = "md5"

    def validate(self) -> "BloomParams":
        numbers = (self.size, self.hash_count, self.capacity)
        if any(n is None or n < low for n, low in zip(numbers, (1, 1, 0))):
            raise ValueError(f"wrong filter parameters: {self}")
        if self.inserted_count is None or self.inserted_count < 0 or self.hasher not in HASHERS:
            raise ValueError(f"wrong filter parameters: {self}")
        return self


@dataclass(frozen=True)
class BloomTables:
    params: BloomParams
    words: DataFrame


def bloom_sizing(capacity: Column, fpr: Column) -> tuple[Column, Column]:
    """Bits and number of hashes for ``capacity`` keys at false-positive rate ``fpr``."""
    ln2 = math.log(2)
    bits = F.floor(-capacity * F.log(fpr) / F.lit(ln2 * ln2))
    size = F.greatest(F.lit(1).cast("bigint"), bits)
    hashes = F.when(capacity == 0, F.lit(1)).otherwise(
        F.greatest(F.lit(1).cast("bigint"), F.floor(size / capacity * F.lit(ln2)))
    )
    return size, hashes.cast("int")


def bloom_inverse_sizing(size: Column, hash_count: Column) -> tuple[Column, Column]:
    """Keys and false-positive rate that a filter of this size and number of hashes is made for."""
    ln2 = math.log(2)
    capacity = F.greatest(F.lit(1).cast("bigint"), F.floor(size / hash_count * F.lit(ln2)))
    return capacity, F.exp(-size / capacity * F.lit(ln2 * ln2))


def bloom_params_table(users: DataFrame, fpr: float = DEFAULT_FPR, hasher: str = "md5") -> DataFrame:
    """Parameters for the distinct ``user`` values of ``users``, one row."""
    distinct = users.select("user").filter(F.col("user").isNotNull()).distinct()
    counted = distinct.agg(F.count(F.lit(1)).alias("capacity"))
    size, hashes = bloom_sizing(F.col("capacity"), F.lit(float(fpr)))
    return counted.select(
        size.alias("size"), hashes.alias("hash_count"), "capacity",
        F.lit(float(fpr)).alias("false_positive_rate"),
        F.col("capacity").alias("inserted_count"), F.lit(hasher).alias("hasher"),
    )


def bloom_params(users: DataFrame, fpr: float = DEFAULT_FPR, hasher: str = "md5") -> BloomParams:
    return BloomParams(**bloom_params_table(users, fpr, hasher).first().asDict()).validate()


def bloom_params_from_size(spark: SparkSession, size: int, hash_count: int) -> BloomParams:
    capacity, fpr = bloom_inverse_sizing(F.lit(size), F.lit(hash_count))
    row = spark.range(1).select(capacity.alias("capacity"), fpr.alias("fpr")).first()
    return BloomParams(size, hash_count, row["capacity"], row["fpr"]).validate()


def _positions(key: Column, params: BloomParams) -> list[Column]:
    return [
        seeded_position(key, F.lit(seed), params.size, params.hasher)
        for seed in range(params.hash_count)
    ]


def _word(position: Column) -> Column:
    return F.shiftright(position, 6)


def _mask(position: Column) -> Column:
    bit = position.bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def bloom_words(users: DataFrame, params: BloomParams) -> DataFrame:
    """Words of the filter for ``user`` values; a repeated user changes nothing.

    ``bit_or`` is aggregated before the shuffle, so a heavy user is one row per task.
    """
    positions = users.filter(F.col("user").isNotNull()).select(
        F.explode(F.array(*_positions(F.col("user"), params))).alias("position")
    )
    return positions.groupBy(_word(F.col("position")).alias("word")).agg(
        F.bit_or(_mask(F.col("position"))).alias("bits")
    )


def bloom_bits(words: DataFrame) -> DataFrame:
    """Set bits of the words, one row each: ``bit``."""
    places = F.explode(F.sequence(F.lit(0), F.lit(WORD_BITS - 1))).alias("place")
    is_set = F.getbit(F.col("bits"), F.col("place")) == 1
    return words.select("word", "bits", places).filter(is_set).select(
        (F.col("word") * WORD_BITS + F.col("place")).alias("bit")
    )


def bloom_build(
    labelled: DataFrame, fpr: float = DEFAULT_FPR, hasher: str = "md5"
) -> BloomTables:
    """Filter of the distinct users with label 1, built now: one pass over ``labelled``.

    The users are written once for sizing and hashing, the words once for every later lookup.
    """
    users = cut_lineage(distinct_positive_users(labelled.filter(F.col("user").isNotNull())))
    params = bloom_params(users, fpr, hasher)
    return BloomTables(params, cut_lineage(bloom_words(users, params)))


def bloom_lookup(
    df: DataFrame,
    filter_tables: BloomTables,
    key: str = "user",
    name: str = "prediction",
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """``name`` = 1 where every bit of the key is set, else 0 (also for a null key).

    The words of a filter of bounded size are broadcast and tested row by row without a shuffle.
    A larger filter is tested on the distinct keys, and the hits are joined back.
    """
    params, words = filter_tables.params, filter_tables.words
    if math.ceil(params.size / WORD_BITS) <= broadcast_words:
        tested = df
        hit = F.col(key).isNotNull()
        for seed, position in enumerate(_positions(F.col(key), params)):
            word, bits = f"_word{seed}", f"_bits{seed}"
            side = words.select(F.col("word").alias(word), F.col("bits").alias(bits))
            tested = tested.withColumn(f"_at{seed}", position)
            tested = tested.join(F.broadcast(side), _word(F.col(f"_at{seed}")) == F.col(word), "left")
            mask = _mask(F.col(f"_at{seed}"))
            hit &= F.coalesce(F.col(bits).bitwiseAND(mask) != 0, F.lit(False))
        return tested.withColumn(name, hit.cast("int")).select(*df.columns, name)
    if df.isStreaming:
        raise ValueError("a filter this large is looked up per batch: call this inside foreachBatch")
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    asked = keys.select(
        key, F.explode(F.array(*_positions(F.col(key), params))).alias("_at")
    ).withColumn("word", _word(F.col("_at")))
    found = F.coalesce(F.col("bits").bitwiseAND(_mask(F.col("_at"))) != 0, F.lit(False))
    hits = (
        asked.join(words, "word", "left")
        .groupBy(key)
        .agg(F.min(found.cast("int")).alias(name))
    )
    return lookup_join(df, hits, [key], "left").fillna({name: 0}).select(*df.columns, name)


def membership_filter(
    df: DataFrame, filter_tables: BloomTables, keep_members: bool = False, key: str = "user"
) -> DataFrame:
    """Approximate semi join (members) or anti join (the rest) to the filter's set."""
    looked_up = bloom_lookup(df, filter_tables, key, "_member")
    return looked_up.filter(F.col("_member") == int(keep_members)).drop("_member")


def exact_membership_filter(
    df: DataFrame, members: DataFrame, keep_members: bool = False, key: str = "user"
) -> DataFrame:
    """The exact counterpart of ``membership_filter`` on a table of members."""
    listed = members.select(key).filter(F.col(key).isNotNull()).distinct()
    return lookup_join(df, listed, [key], "left_semi" if keep_members else "left_anti")


def bloom_measured_fpr(keys: DataFrame, members: DataFrame, filter_tables: BloomTables) -> DataFrame:
    """Share of the distinct keys outside ``members`` that the filter takes for members."""
    asked = keys.select("user").filter(F.col("user").isNotNull()).distinct()
    unseen = exact_membership_filter(asked, members)
    return bloom_lookup(unseen, filter_tables).agg(
        F.count(F.lit(1)).alias("unseen_keys"),
        F.coalesce(F.avg("prediction"), F.lit(0.0)).alias("measured_fpr"),
    )


def bloom_health(filter_tables: BloomTables) -> DataFrame:
    """One-row summary: parameters, set bits, fill ratio, whether the capacity is reached."""
    params = filter_tables.params
    bits = F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("set_bits")
    return filter_tables.words.agg(bits).select(
        F.lit(params.size).cast("bigint").alias("size"),
        F.lit(params.hash_count).alias("hash_count"),
        F.lit(params.capacity).cast("bigint").alias("capacity"),
        F.lit(params.inserted_count).cast("bigint").alias("inserted_count"),
        "set_bits",
        (F.col("set_bits") / F.lit(params.size)).alias("fill_ratio"),
        F.lit(params.inserted_count >= params.capacity).alias("at_capacity"),
    )


def bloom_reset(spark: SparkSession, params: BloomParams) -> BloomTables:
    """An empty filter of the same shape; save it as a new version to forget everything."""
    empty = BloomParams(
        params.size, params.hash_count, params.capacity, params.false_positive_rate, 0, params.hasher
    )
    return BloomTables(empty, spark.createDataFrame([], "word bigint, bits bigint"))


def bloom_merge(one: BloomTables, two: BloomTables) -> BloomTables:
    """The filter of both filters' keys: the words of one shape are joined by ``or``.

    Inserts are added up, so a key in both counts twice towards the capacity.
    """
    same = ("size", "hash_count", "capacity", "false_positive_rate", "hasher")
    a, b = one.params, two.params
    if any(getattr(a, name) != getattr(b, name) for name in same):
        raise ValueError(f"filters of different shape: {a}, {b}")
    words = one.words.unionByName(two.words).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return BloomTables(replace(a, inserted_count=a.inserted_count + b.inserted_count), cut_lineage(words))


def bloom_preset(spark: SparkSession, capacity: int, fpr: float = DEFAULT_FPR, hasher: str = "md5") -> BloomTables:
    """An empty filter made for ``capacity`` keys, to insert into."""
    size, hashes = bloom_sizing(F.lit(capacity).cast("bigint"), F.lit(float(fpr)))
    row = spark.range(1).select(size.alias("size"), hashes.alias("hash_count")).first()
    params = BloomParams(row["size"], row["hash_count"], capacity, float(fpr), 0, hasher).validate()
    return bloom_reset(spark, params)


def bloom_insert(filter_tables: BloomTables, users: DataFrame) -> BloomTables:
    """The filter with more keys (``user``). Only keys that it does not seem to hold yet count as inserts."""
    asked = users.select("user").filter(F.col("user").isNotNull()).distinct()
    new = cut_lineage(bloom_lookup(asked, filter_tables).filter("prediction = 0").select("user"))
    added = BloomTables(replace(filter_tables.params, inserted_count=new.count()), bloom_words(new, filter_tables.params))
    return bloom_merge(filter_tables, added)


def bloom_save(
    filter_tables: BloomTables, path: str, version: int | None = None, owner: str | None = None, batch: int | None = None
) -> int:
    """Write a version, the next one by default: its words, then one log file with the parameters.

    Readers see the version before until that file is there. See ``versions.publish``.
    """
    about = json.dumps(asdict(filter_tables.params.validate()))
    return versions.publish(filter_tables.words, path, version, about, owner, batch)


def bloom_newest_version(spark: SparkSession, path: str) -> int | None:
    """Number of the newest complete version; None where there is none yet."""
    return versions.newest_version(spark, path)


def bloom_load(spark: SparkSession, path: str, version: int | None = None) -> BloomTables:
    """Read a version (the newest by default) and check it before use."""
    found = versions.find_version(spark, path, version)
    if found is None:
        raise ValueError(f"no filter at {path}")
    return bloom_of_version(spark, path, found)


def bloom_of_version(spark: SparkSession, path: str, version: versions.Version) -> BloomTables:
    try:
        params = BloomParams(**json.loads(version.about)).validate()
    except (TypeError, json.JSONDecodeError) as wrong:
        raise ValueError(f"wrong filter at {path}: no parameters") from wrong
    words = versions.rows_of(spark, path, "word bigint, bits bigint", version)
    check = words.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("word").alias("words"),
        F.min("word").alias("low"), F.max("word").alias("high"),
    ).first()
    last = (params.size - 1) // WORD_BITS
    if check["rows"] and (check["low"] < 0 or check["high"] > last or check["rows"] != check["words"]):
        raise ValueError(f"wrong filter at {path}: words outside 0..{last} or repeated")
    return BloomTables(params, words)
