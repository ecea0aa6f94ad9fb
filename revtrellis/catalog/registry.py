"""Registration of queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from revtrellis.lens.source import LensSource, with_entities
from revtrellis.session import ensure_settings

AS_OF = date(1998, 6, 17)

_QUERIES: dict[str, Callable[[LensSource], DataFrame]] = {}
_CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register a function of a table source under a name."""

    def register(fn: Callable[[LensSource], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if check is not None:
            _CHECKS[name] = check
        return fn

    return register


def _load() -> None:
    from revtrellis.catalog import basics, conversion, cubes, leads, reports, sales, scorecards  # noqa: F401


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn):
        return lambda spark, path: fn(LensSource(ensure_settings(spark), path))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def checking_sql() -> dict[str, str]:
    _load()
    return {name: with_entities(sql) for name, sql in _CHECKS.items()}
