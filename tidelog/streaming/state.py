"""State across micro-batches, kept as small tables written per batch.

A keyed state function would hand all rows of a hot topic to one task. Here a micro-batch runs the
distributed batch operator, and only one row per topic passes from batch to batch. Each batch reads
the newest state written before it and writes its own folder, so a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidelog.operators.streaks import fill_last_good
from tidelog.session import cut_lineage


def read_state(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """State after the batch before `batch_id`."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id - 1}")


def write_state(state: DataFrame, path: str, batch_id: int) -> None:
    state.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def fill_batch(
    batch: DataFrame, state: DataFrame, topic: str, position: str, ts: str
) -> tuple[DataFrame, DataFrame]:
    """One micro-batch of `fill_last_good`, and the state after it.

    The state enters as a row before the topic's first row.
    """
    seed = state.select(
        topic, F.lit(None).cast(batch.schema[position].dataType).alias(position), F.col("last_ts").alias(ts)
    ).withColumn("_seed", F.lit(0))
    rows = batch.withColumn("_seed", F.lit(1)).unionByName(seed, allowMissingColumns=True)
    filled = fill_last_good(rows, [topic], ["_seed", position], ts)
    newest = F.max_by("filled_ts", F.struct("_seed", position)).alias("last_ts")
    after = filled.groupBy(topic).agg(newest)
    return filled.filter("_seed = 1").drop("_seed"), after


def streak_batch(
    batch: DataFrame, state: DataFrame, topic: str, failed: str, batch_id: int
) -> DataFrame:
    """State of batch-level failure streaks: a batch fails when all its rows of a topic fail.

    Rows are counted per topic first; a topic without rows in the batch keeps its streak. The state
    has `streak`, `flagged` stays true until a success.
    """
    counts = batch.groupBy(topic).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(failed).alias("_failed")
    )
    joined = state.join(counts, topic, "full_outer")
    all_failed = F.col("_rows") == F.col("_failed")
    before = F.coalesce("streak", F.lit(0).cast("bigint"))
    return joined.select(
        topic,
        F.when(F.col("_rows").isNull(), before)
        .when(all_failed, before + 1)
        .otherwise(F.lit(0).cast("bigint"))
        .alias("streak"),
        F.when(F.col("_rows").isNull() | all_failed, F.coalesce("since_batch", F.lit(batch_id).cast("bigint")))
        .alias("since_batch"),
    ).withColumn("since_batch", F.when(F.col("streak") > 0, F.col("since_batch")))


STREAK_STATE = "{topic} string, streak bigint, since_batch bigint"
FILL_STATE = "{topic} string, last_ts timestamp"


def stream_last_good(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    topic: str = "topic",
    position: str = "position",
    ts: str = "ts",
    trigger: dict[str, object] | None = None,
) -> DataStreamWriter:
    """Write every micro-batch with `filled_ts` to `path/rows`, and the last times to `path/state`."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = read_state(spark, f"{path}/state", batch_id, FILL_STATE.format(topic=topic))
        filled, after = fill_batch(batch, state, topic, position, ts)
        filled.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        write_state(after, f"{path}/state", batch_id)

    return _writer(stream, step, checkpoint, trigger)


def stream_failure_streaks(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    topic: str = "topic",
    failed: str = "failed",
    threshold: int = 3,
    trigger: dict[str, object] | None = None,
) -> DataStreamWriter:
    """Keep streaks in `path/state`; write a finding to `path/findings` when one reaches the threshold."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = read_state(spark, f"{path}/state", batch_id, STREAK_STATE.format(topic=topic))
        write_state(streak_batch(batch, before, topic, failed, batch_id), f"{path}/state", batch_id)
        after = read_state(spark, f"{path}/state", batch_id + 1, STREAK_STATE.format(topic=topic))
        old = before.select(topic, F.col("streak").alias("_old"))
        reached = after.join(old, topic, "left").filter(
            (F.col("streak") >= threshold) & (F.coalesce("_old", F.lit(0)) < threshold)
        )
        reached.drop("_old").write.mode("overwrite").parquet(f"{path}/findings/batch_id={batch_id}")

    return _writer(stream, step, checkpoint, trigger)


def _writer(
    stream: DataFrame,
    step: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict[str, object] | None,
) -> DataStreamWriter:
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True}))


HOLD_STATE = "pending_since timestamp, last_true timestamp, fired boolean"


def hold_batch(
    ticks: DataFrame, state: DataFrame, by: list[str], condition: Column, hold_minutes: int, tick_minutes: int, tick: str = "tick"
) -> tuple[DataFrame, DataFrame]:
    """Alerts that fire within a micro-batch of evaluated ticks, and the spans that are still open after it.

    `state` has one open span a series. A span goes on if the first true tick of the batch is the next one; it ends
    with a tick of its series that is false or leaves one out. Ticks of a series arrive in order.
    """
    spacing = tick_minutes * 60
    seconds = F.unix_seconds(F.col(tick).cast("timestamp"))
    order = W.partitionBy(*by).orderBy(tick)
    island = ticks.filter(condition).withColumn("_span", seconds - F.row_number().over(order) * spacing)
    spans = island.groupBy(*by, "_span").agg(F.min(tick).cast("timestamp").alias("_from"), F.max(tick).cast("timestamp").alias("_to"))
    newest = ticks.groupBy(*by).agg(F.max(tick).cast("timestamp").alias("_newest"))
    open_spans = state.select(*by, "pending_since", F.col("last_true").alias("_last"), "fired")
    next_tick = F.timestamp_seconds(F.unix_seconds("_last") + spacing)
    # A series has one open span, so the join adds no rows.
    joined = spans.join(open_spans, by, "left").withColumn("_goes_on", F.coalesce(next_tick == F.col("_from"), F.lit(False)))
    since = F.when(F.col("_goes_on"), F.col("pending_since")).otherwise(F.col("_from"))
    merged = joined.select(
        *by, since.alias("pending_since"), F.col("_to").alias("last_true"), (F.col("_goes_on") & F.col("fired")).alias("_before")
    ).withColumn("firing_at", F.col("pending_since") + F.expr(f"INTERVAL {hold_minutes} MINUTE"))
    merged = merged.withColumn("fired", F.col("last_true") >= F.col("firing_at"))
    alerts = merged.filter(F.col("fired") & ~F.col("_before")).select(*by, "pending_since", "firing_at")
    kept = merged.join(newest, by).filter(F.col("last_true") == F.col("_newest")).select(*by, "pending_since", "last_true", "fired")
    silent = state.join(newest.select(*by), by, "left_anti").select(*by, "pending_since", "last_true", "fired")
    return alerts, kept.unionByName(silent)


def stream_holds(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    by: list[str],
    condition: Column,
    hold_minutes: int,
    tick_minutes: int,
    *,
    tick: str = "tick",
    trigger: dict[str, object] | None = None,
) -> DataStreamWriter:
    """Write each alert once, to `path/alerts`, with the tick it fires at; open spans are kept in `path/state`.

    `ticks` are evaluated series whose ticks come once and in order, such as closed windows in append mode. The
    alerts are those of `pending_alerts` over all ticks, however they are cut into batches.
    """
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ticks.select(*by).schema)

    def step(batch: DataFrame, batch_id: int) -> None:
        state = read_state(batch.sparkSession, f"{path}/state", batch_id, f"{kinds}, {HOLD_STATE}")
        alerts, after = hold_batch(cut_lineage(batch), state, by, condition, hold_minutes, tick_minutes, tick)
        alerts.write.mode("overwrite").parquet(f"{path}/alerts/batch_id={batch_id}")
        write_state(after, f"{path}/state", batch_id)

    return _writer(ticks, step, checkpoint, trigger)
