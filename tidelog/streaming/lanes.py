"""Two lanes: a bulk drain must not delay live rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelog.sinks.entries import stream_entries


@dataclass(frozen=True)
class Lane:
    """One stream with its own target, checkpoint, trigger and scheduler pool."""

    name: str
    stream: DataFrame
    path: str
    checkpoint: str
    shape: Callable[[DataFrame], DataFrame] = lambda df: df
    trigger: dict[str, object] | None = None


def start_lanes(spark: SparkSession, lanes: list[Lane]) -> list[StreamingQuery]:
    """Start one query per lane, each in the pool of its name (set `spark.scheduler.mode=FAIR`)."""
    queries = []
    for lane in lanes:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", lane.name)
        writer = stream_entries(
            lane.stream, lane.path, lane.checkpoint, shape=lane.shape, trigger=lane.trigger, pool=lane.name
        )
        queries.append(writer.queryName(f"lane-{lane.name}").start())
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    return queries
