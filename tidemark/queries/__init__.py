"""Every operator as a query over the test tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.queries import bar_queries, factor_queries, feed_queries, panel_queries, stream_queries

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (panel_queries, factor_queries, bar_queries, feed_queries, stream_queries)


def all_queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
