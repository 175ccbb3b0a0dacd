"""Stable hashes. md5 gives the same bucket in any engine; xxhash64 is faster but Spark-only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASHERS = ("md5", "xxhash64")


def md5_number(text: Column, digits: int = 8) -> Column:
    """The first ``digits`` hex digits of md5 as a non-negative bigint (null stays null)."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def hash_share(col: Column, hasher: str = "md5") -> Column:
    """Position of a value in [0, 1) in steps of 1/1000; null for null."""
    text = col.cast("string")
    if hasher == "md5":
        number = md5_number(text)
    elif hasher == "xxhash64":
        number = F.when(text.isNotNull(), F.xxhash64(text))
    else:
        raise ValueError(f"hasher must be one of {HASHERS}")
    return F.pmod(number, F.lit(1000)) / F.lit(1000)


def seeded_position(key: Column, seed: Column, size: int, hasher: str = "md5") -> Column:
    """Position of ``key`` in [0, size) under hash number ``seed``."""
    if hasher == "md5":
        number = md5_number(F.concat(seed.cast("string"), F.lit(":"), key), 15)
    elif hasher == "xxhash64":
        number = F.when(key.isNotNull(), F.xxhash64(seed.cast("int"), key))
    else:
        raise ValueError(f"hasher must be one of {HASHERS}")
    return F.pmod(number, F.lit(size).cast("bigint"))


def unit_uniform(text: Column) -> Column:
    """A number in (0, 1) that depends on ``text`` only."""
    return (md5_number(text) + F.lit(0.5)) / F.lit(float(1 << 32))
