"""Registered queries: each a Spark function over the given tables and, where SQL can say it, its check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hardwood.catalog import build_queries, load_queries, mart_queries, merge_queries, quality_queries, source_queries
from hardwood.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (mart_queries, build_queries, merge_queries, quality_queries, source_queries, load_queries)


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    run.__name__ = query.__name__
    return run


def queries() -> dict[str, Query]:
    return {name: _prepared(query) for module in _MODULES for name, (query, _) in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, (_, sql) in module.QUERIES.items() if sql}
