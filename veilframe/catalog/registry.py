"""The registered queries: a Spark callable and, where SQL can say it, its twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return register
