"""Registry of the checked queries: a Spark callable and, where SQL can say it, the same in SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidebars.catalog.sql import using

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_MODULES = ("cleaning", "landing", "storage", "windows", "averages", "model", "jobs")


def query(name: str, sql: str | None = None, uses: str = ""):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` may read the fixtures in ``uses``."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = using(uses, sql) if uses else sql
        return fn

    return add


def load() -> None:
    for module in _MODULES:
        importlib.import_module(f"tidebars.catalog.{module}")
