"""Where queries and their SQL twins are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_BEFORE: list[Callable[[], None]] = []


def before(f: Callable[[], None]) -> Callable[[], None]:
    """Register what is to run before a query: column expressions need a session, names and SQL don't."""
    _BEFORE.append(f)
    return f


class Tables:
    """The driver's tables by name: tables.documents and so on."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of Tables under a name."""

    def keep(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            for make in _BEFORE:
                make()
            return f(Tables(spark, folder))

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return f

    return keep
