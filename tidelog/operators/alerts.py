"""Conditions that must hold for a while before they fire."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def pending_alerts(
    ticks: DataFrame,
    condition: Column,
    hold_minutes: int,
    tick_minutes: int = 1,
    by: Sequence[str] = (),
    tick: str = "tick",
) -> DataFrame:
    """Spans of consecutive ticks on which the condition held for at least `hold_minutes`.

    `ticks` holds evaluated series, one row per tick and series, so its size is the number of
    evaluations and not the number of events. A missing tick ends a span.
    """
    spacing = tick_minutes * 60
    order = W.partitionBy(*(by or [F.lit(0)])).orderBy(tick)
    seconds = F.unix_seconds(F.col(tick).cast("timestamp"))
    true_ticks = ticks.filter(condition).withColumn(
        "_span", seconds - F.row_number().over(order) * spacing
    )
    spans = true_ticks.groupBy(*by, "_span").agg(
        F.min(tick).alias("pending_since"), F.max(tick).alias("last_true"), F.count("*").alias("ticks")
    )
    hold = F.expr(f"INTERVAL {hold_minutes} MINUTE")
    fired = F.col("pending_since") + hold
    return (
        spans.filter(F.col("last_true") >= fired)
        .withColumn("firing_at", fired)
        .select(*by, "pending_since", "firing_at", "last_true", "ticks")
    )
