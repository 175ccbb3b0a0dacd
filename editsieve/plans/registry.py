"""Registry of queries: a Spark function and, where SQL can say it, its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: QueryFunction
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(covers: str, oracle: str | None = None):
    """Register a function under its name; ``covers`` lists inventory ids."""

    def register(run: QueryFunction) -> QueryFunction:
        name = run.__name__
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = Query(name, covers, run, oracle)
        return run

    return register
