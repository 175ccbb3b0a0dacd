"""Versioned tables in a shared folder: attempts that nobody rewrites, and a log whose newest file decides.

    rows/<attempt>/           the rows of one attempt, in a folder of its own
    log/segment=<n>/          one small file for each version: its number, its attempt, what is known about it, and
                              the last batch that each writer has committed
    leases/                   which versions readers still need, and until when
    retired/                  attempts that are to be emptied, or are

A version exists once its log file does, and that file appears whole, by a rename. A failed or repeated attempt leaves
a folder that no log file names. A writer that repeats a batch finds it in the log and writes nothing. Writers are told
apart by a name of their own, so that batch numbers may start again with a new checkpoint; there is one writer at a time.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

SEGMENT = 256  # versions whose log files share a folder
_LOG = "sequence bigint, version bigint, attempt string, about string, done map<string,bigint>"
_LEASE = "attempt string, until double"
_RETIRED = "attempt string, version bigint, emptied boolean"


@dataclass(frozen=True)
class Version:
    number: int
    attempt: str
    about: str = ""
    sequence: int = 0
    done: dict = field(default_factory=dict)


def _table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The rows below a folder, none if it is not there yet."""
    try:
        return spark.read.schema(ddl).json(path)
    except AnalysisException:
        return spark.createDataFrame([], ddl)


def _append(spark: SparkSession, path: str, ddl: str, row: tuple) -> None:
    """One row as one file, which appears whole."""
    spark.createDataFrame([row], ddl).coalesce(1).write.mode("append").json(path)


def _log(spark: SparkSession, path: str) -> DataFrame:
    return _table(spark, f"{path}/log", f"{_LOG}, segment bigint")


def _first(log: DataFrame, *order: str) -> Version | None:
    row = log.orderBy(*[F.desc(name) for name in order], "attempt").limit(1).collect()
    if not row:
        return None
    r = row[0]
    return Version(r["version"], r["attempt"], r["about"] or "", r["sequence"], dict(r["done"] or {}))


def last_commit(spark: SparkSession, path: str) -> Version | None:
    return _first(_log(spark, path), "sequence")


def is_done(spark: SparkSession, path: str, owner: str, batch: int) -> bool:
    """Whether ``owner`` has committed ``batch`` or a later one."""
    last = last_commit(spark, path)
    return last is not None and last.done.get(owner, -1) >= batch


def publish(
    df: DataFrame, path: str, version: int | None = None, about: str = "", owner: str | None = None,
    batch: int | None = None,
) -> int:
    """Write ``df`` as the next version, or again as ``version``; gives the number.

    With ``owner`` and ``batch`` the batch counts as committed together with the version. If it
    is already, nothing is written and the newest number comes back.
    """
    spark = df.sparkSession
    last = last_commit(spark, path)
    done = dict(last.done) if last else {}
    if owner is not None:
        if done.get(owner, -1) >= batch:
            return newest_version(spark, path)
        done[owner] = batch
    attempt = uuid.uuid4().hex
    df.write.parquet(f"{path}/rows/{attempt}")
    if version is None:
        newest = newest_version(spark, path)
        version = 0 if newest is None else newest + 1
    sequence = last.sequence + 1 if last else 0
    _append(spark, f"{path}/log/segment={sequence // SEGMENT}", _LOG, (sequence, version, attempt, about, done))
    return version


def newest_version(spark: SparkSession, path: str, below: int | None = None) -> int | None:
    """The newest whole version, older than ``below`` if given; None where there is none."""
    log = _log(spark, path)
    if below is not None:
        log = log.filter(F.col("version") < below)
    return log.agg(F.max("version")).first()[0]


def find_version(spark: SparkSession, path: str, version: int | None = None) -> Version | None:
    """The log entry of a version, the newest by default; of one that was written again the last."""
    log = _log(spark, path)
    return _first(log, "version", "sequence") if version is None else _first(log.filter(F.col("version") == version), "sequence")


def rows_of(spark: SparkSession, path: str, schema: str, version: Version) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/rows/{version.attempt}")


def read_version(spark: SparkSession, path: str, schema: str, version: int | None) -> DataFrame:
    """The rows of a version; an empty table where there is none."""
    if version is None:
        return spark.createDataFrame([], schema)
    found = find_version(spark, path, version)
    if found is None:
        raise ValueError(f"no version {version} at {path}")
    if _is_retired(spark, path, found):
        raise ValueError(f"version {version} at {path} is retired")
    return rows_of(spark, path, schema, found)


def _is_retired(spark: SparkSession, path: str, version: Version) -> bool:
    retired = _table(spark, f"{path}/retired", _RETIRED)
    return not retired.filter(F.col("attempt") == version.attempt).isEmpty()


def lease_newest(spark: SparkSession, path: str, seconds: float) -> Version | None:
    """The newest version, kept from being emptied for ``seconds``; None where there is none.

    The lease is written before it is looked up whether the version is retired, and ``retain``
    marks a version before it looks for leases, so one of the two sees the other.
    """
    while True:
        found = find_version(spark, path)
        if found is None:
            return None
        _append(spark, f"{path}/leases", _LEASE, (found.attempt, time.time() + seconds))
        if not _is_retired(spark, path, found):
            return found


def retain(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Empty all versions but the newest ``keep`` and those leased; gives how many were emptied.

    A version that is leased while it is retired is emptied by a later call. Versions that were
    written again and attempts that came second count as older ones.
    """
    if keep < 1:
        raise ValueError("at least one version has to stay")
    log = _log(spark, path)
    stay = [r["attempt"] for r in log.orderBy(F.desc("version"), F.desc("sequence")).limit(keep).collect()]
    marks = _table(spark, f"{path}/retired", _RETIRED)
    emptied = marks.filter("emptied").select("attempt")
    old = log.filter(~F.col("attempt").isin(stay)).select("attempt", "version")
    old = old.join(emptied, "attempt", "left_anti").collect()
    marked = {r["attempt"] for r in marks.select("attempt").distinct().join(log, "attempt", "left_semi").collect()}
    fresh = [(r["attempt"], r["version"], False) for r in old if r["attempt"] not in marked]
    if fresh:
        spark.createDataFrame(fresh, _RETIRED).coalesce(1).write.mode("append").json(f"{path}/retired")
    leases = _table(spark, f"{path}/leases", _LEASE).filter(F.col("until") > time.time())
    leased = {r["attempt"] for r in leases.select("attempt").distinct().collect()}
    gone = [r for r in old if r["attempt"] not in leased]
    for r in gone:
        folder = f"{path}/rows/{r['attempt']}"
        spark.read.parquet(folder).limit(0).write.mode("overwrite").parquet(folder)
    if gone:
        rows = [(r["attempt"], r["version"], True) for r in gone]
        spark.createDataFrame(rows, _RETIRED).coalesce(1).write.mode("append").json(f"{path}/retired")
    return len(gone)
