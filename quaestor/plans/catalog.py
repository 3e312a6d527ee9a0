"""Registry of the library's queries and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import answer_queries, checked_queries, document_queries, file_queries, index_queries, portal_queries, relational_queries, search_queries, source_queries, text_queries, update_queries  # noqa: F401  they register on import
from .registry import QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
