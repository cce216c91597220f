"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def naive_times(df: DataFrame) -> DataFrame:
    """Zoned timestamps as UTC wall-clock columns, the type the SQL side has."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register `fn(spark, sf_dir)` under `name`, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return naive_times(fn(use_utc(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
