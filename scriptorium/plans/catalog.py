"""The registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with its SQL where it can be said in SQL."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


_BUILT: dict[tuple[str, str, str], Any] = {}


def built_once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], Any]) -> Any:
    """Fitted models and stored tables are shared by the queries of one application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]
