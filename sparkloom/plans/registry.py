"""All queries of the library by name, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL twin."""

    def add(f: Query) -> Query:
        if f.__name__ in _QUERIES:
            raise ValueError(f"{f.__name__} is registered already")
        _QUERIES[f.__name__] = f
        if sql is not None:
            _ORACLES[f.__name__] = sql
        return f

    return add


def _load() -> None:
    from sparkloom.plans import catalog, documents, duplicates, spaces, web  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkloom.plans.documents import flagship as f

    return f(spark, sf_dir)


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
