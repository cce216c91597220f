"""Event-time windows, redelivery, late rows.

Every function takes a streaming or a batch frame: on a batch frame the watermark is ignored, which
gives the twin a stream is compared with.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidelog.functions.labels import stream_key
from tidelog.functions.times import instant, seconds_between

# How late rows of a source normally are: files appear hours after their events.
LATENESS = {"eventlogfile": "6 hours", "eventlog_objects": "10 minutes", "pubsub": "5 minutes"}


def event_clock(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need a zoned timestamp; naive columns are taken as UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def windowed_counts(
    df: DataFrame,
    by: Sequence[str | Column],
    size: str,
    slide: str | None = None,
    lateness: str = "6 hours",
    ts: str = "ts",
) -> DataFrame:
    """Rows per window and group; tumbling without `slide`."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    counted = (
        df.withWatermark(ts, lateness)
        .groupBy(window.alias("_w"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rest = [c for c in counted.columns if c not in ("_w", "n")]
    return counted.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *rest, "n"
    )


def dedup_redelivered(
    df: DataFrame, lateness: str = "6 hours", ts: str = "ts", keys: Sequence[str] | None = None
) -> DataFrame:
    """Collapse at-least-once copies that arrive within the lateness of each other."""
    if keys is None:
        df = df.withColumns(
            {"_stream": stream_key(F.col("labels")), "_line": F.sha2(F.col("line"), 256)}
        )
        keys = ["_stream", ts, "_line"]
    if not df.isStreaming:
        return df.dropDuplicates(list(keys)).drop("_stream", "_line")
    return (
        df.withWatermark(ts, lateness)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("_stream", "_line")
    )


def split_late(
    df: DataFrame, arrived: Column | datetime | str, bound_seconds: int, ts: str = "ts"
) -> tuple[DataFrame, DataFrame]:
    """Rows within the bound, and the late ones; a row without a time is late."""
    marked = mark_late(df, arrived, bound_seconds, ts)
    late = F.coalesce(F.col("late"), F.lit(True))
    return marked.filter(~late).drop("late", "lag_seconds"), marked.filter(late)


def stream_late_rows(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    arrived: Column | datetime | str,
    bound_seconds: int,
    *,
    ts: str = "ts",
    trigger: dict[str, object] | None = None,
) -> DataStreamWriter:
    """Write every micro-batch to `path/rows`, and its late rows to the side table `path/late`.

    Windows downstream read the rows; what their watermark would drop without a trace is kept, with
    its lag, in the side table. A replayed batch overwrites what it wrote.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        good, late = split_late(kept, arrived, bound_seconds, ts)
        good.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        late.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        kept.unpersist()

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True}))


def mark_late(
    df: DataFrame, arrived: Column | datetime | str, bound_seconds: int, ts: str = "ts"
) -> DataFrame:
    """Add `lag_seconds` and `late`, before any aggregation could drop the row."""
    lag = seconds_between(instant(arrived), F.col(ts))
    return df.withColumn("lag_seconds", lag).withColumn("late", lag > bound_seconds)


def stream_top_per_window(
    df: DataFrame, key: str, k: int, size: str, lateness: str = "6 hours", ts: str = "ts", most_keys: int = 10_000
) -> DataFrame:
    """The `k` most frequent keys of every closed window, with their counts and ranks; ties go by key.

    Two stateful steps in append mode: counts per window and key, and the first `k` of the counts of a window once
    it is closed. The second gathers one row per key of a window, so keys are taken to be few, such as
    event types; a window with more than `most_keys` of them fails instead of being cut.
    """
    counted = df.withWatermark(ts, lateness).groupBy(F.window(ts, size).alias("_w"), key).agg(F.count(F.lit(1)).alias("n"))
    order = F.struct((-F.col("n")).alias("least"), F.col(key).alias("key"))
    kept = F.sort_array(F.collect_list(order)).alias("_top")
    tops = counted.groupBy(F.window(F.window_time("_w"), size).alias("_w")).agg(kept, F.count(F.lit(1)).alias("_keys"))
    few = F.when(F.col("_keys") <= most_keys, F.slice("_top", 1, k)).otherwise(F.raise_error(F.lit("a window has too many keys for a top list")))
    found = tops.select(F.col("_w.start").alias("window_start"), F.posexplode(few).alias("place", "_row"))
    return found.select(
        "window_start", F.col("_row.key").alias(key), (-F.col("_row.least")).alias("n"), (F.col("place") + 1).alias("rank")
    )
