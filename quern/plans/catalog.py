"""Every query of the engine, each with the SQL that an independent engine answers it by."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship


class Tables:
    """The tables of a folder, read when named."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = ship(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
_MODULES = ("relational", "aggregation", "domain", "library", "web", "streams")


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of Tables under a name, with its SQL if SQL can express it."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            _ORACLES[name] = sql
        return f

    return register


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"quern.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
