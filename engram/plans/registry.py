"""Query registry: name -> (Spark builder, optional DuckDB twin SQL).

Builders take ``(spark, data_dir)`` and return a DataFrame; the SQL twin runs
on the same parquet tables registered as views. Column names match exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def all_queries() -> dict[str, Builder]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def _load() -> None:
    # importing the catalog modules fills the registry
    from engram.plans import (  # noqa: F401
        catalog_activity,
        catalog_graph,
        catalog_ontology,
        catalog_search,
        catalog_stream,
        catalog_temporal,
        catalog_text,
    )
