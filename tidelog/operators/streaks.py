"""Order-dependent findings per key: failure streaks, last good time, stalls, ingest clock."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.times import instant
from tidelog.operators.running import running, slice_ordered


def failure_streaks(
    df: DataFrame, by: Sequence[str], order: Sequence[str], failed: Column, threshold: int
) -> DataFrame:
    """Runs of at least `threshold` failures in a row, one finding each.

    A success starts a new island; the failures of an island are counted with a plain aggregate.
    """
    narrow = df.select(*by, *order, failed.alias("_failed"))
    sliced = slice_ordered(narrow, by, order)
    success = F.when(F.col("_failed"), 0).otherwise(1).cast("bigint")
    islands = running(sliced, by, order, {"_island": ("sum", success)})
    position = F.struct(*order)
    return (
        islands.filter("_failed")
        .groupBy(*by, "_island")
        .agg(
            F.count(F.lit(1)).alias("failures"),
            F.min(position).alias("_first"),
            F.max(position).alias("_last"),
        )
        .filter(F.col("failures") >= threshold)
        .select(
            *by,
            "failures",
            *[F.col(f"_first.{c}").alias(f"first_{c}") for c in order],
            *[F.col(f"_last.{c}").alias(f"last_{c}") for c in order],
        )
    )


def fill_last_good(
    df: DataFrame, by: Sequence[str], order: Sequence[str], ts: str, name: str = "filled_ts"
) -> DataFrame:
    """A row without a time takes the latest parsed time seen before it on its topic.

    Rows are ordered by position, not by time; the latest parsed one wins even if it lies earlier.
    """
    sliced = slice_ordered(df, by, order)
    return running(sliced, by, order, {name: ("last", F.col(ts))}).drop("_slice")


def stalls(df: DataFrame, by: Sequence[str], cycle: Sequence[str], watermark: str) -> DataFrame:
    """Cycles whose watermark is the one of the cycle before."""
    sliced = slice_ordered(df.select(*by, *cycle, watermark), by, cycle)
    seen = running(
        sliced, by, cycle, {"previous": ("last", F.col(watermark))}, include_row=False
    )
    return seen.filter(F.col("previous") == F.col(watermark)).drop("_slice")


def ingest_clock(
    df: DataFrame, order: Sequence[str], start: Column | datetime | str, name: str = "ingest_ts"
) -> DataFrame:
    """`start` plus one microsecond per row, in file and row order over the whole run."""
    sliced = slice_ordered(df, [], order)
    counted = running(sliced, [], order, {"_n": ("sum", F.lit(1).cast("bigint"))})
    micros = F.unix_micros(instant(start)) + F.col("_n") - 1
    return counted.withColumn(name, F.timestamp_micros(micros)).drop("_n", "_slice")
