"""Duplicates, versions and set differences. All of them combine on the map side first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.identity import event_category
from tidelog.functions.labels import stream_key


def dedup_entries(df: DataFrame) -> DataFrame:
    """Entries with the same labels, time and line are one entry."""
    keyed = df.withColumns(
        {"_stream": stream_key(F.col("labels")), "_line": F.sha2(F.col("line"), 256)}
    )
    return keyed.dropDuplicates(["_stream", "ts", "_line"]).drop("_stream", "_line")


def _pick(df: DataFrame, key: Sequence[str], order: Column, latest: bool) -> DataFrame:
    choose = F.max_by if latest else F.min_by
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*key).agg(choose(row, order).alias("_row")).select("_row.*")


def first_by_id(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each id in the given order."""
    return _pick(df, [key], F.struct(*order), latest=False)


def latest_by_id(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each id in the given order; a hot id never gathers in one task."""
    return _pick(df, [key], F.struct(*order), latest=True)


def not_processed(df: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key (id, or id and version) is not in the progress table."""
    return df.join(done.select(*on).distinct(), list(on), "left_anti")


def not_owned(names: DataFrame, owned: DataFrame, kind: str) -> DataFrame:
    """Names whose category no other source owns; `owned` has a `category` column."""
    tagged = names.withColumn("category", event_category(F.lit(kind), F.col("name")))
    return tagged.join(owned.select("category").distinct(), "category", "left_anti")


def difference(left: DataFrame, *others: DataFrame) -> DataFrame:
    """Distinct rows of `left` found in none of the others."""
    for other in others:
        left = left.join(other.select(*left.columns).distinct(), left.columns, "left_anti")
    return left.distinct()
