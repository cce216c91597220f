"""Every operator as a named query over the test tables, with its SQL counterpart."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.registry.base import QUERIES, SQL

_MODULES = (
    "scalars", "rules", "shape", "catalogue", "progress", "joins", "aggregates", "windows",
    "dashboard", "alerts", "quality", "streams",
)

for _name in _MODULES:
    importlib.import_module(f"tidelog.registry.{_name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
