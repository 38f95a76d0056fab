"""Named queries, each with the SQL that states its result on the same tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from changeflow.session import prepare


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(prepare(spark), folder)


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (session, folder of parquet tables)."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(name, build, sql)
        return build

    return register
