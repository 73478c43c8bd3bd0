"""Names every query of the library with the SQL that checks it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with its reference SQL where there is one."""

    def keep(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return keep


MODULES = ("signal_jobs", "session_jobs", "event_jobs", "stats_jobs", "shape_jobs", "camera_jobs", "summary_jobs", "source_jobs", "operant_jobs")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"tracewell.jobs.{name}")


def queries() -> dict[str, Query]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["a1_downsample"](spark, sf_dir)
