"""Daily byte budgets and rate caps over micro-batches, with what was used before as state.

Each micro-batch runs the batch operator; between batches pass one row a day (budgets) or one row (caps). State is
written under the batch's number and read from the batch before, so a replayed or restarted batch finds what the
first attempt found. Rows count in the order in which they arrive; within a batch in the given order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidelog.operators.budget import apply_daily_budget, rate_cap_step
from tidelog.session import cut_lineage
from tidelog.streaming.state import _writer, read_state, write_state

BUDGET_STATE = "day date, arrived bigint"
CAP_STATE = "spent double, peak double"


def budget_batch(
    batch: DataFrame, state: DataFrame, budget: int, order: Sequence[str], size: str
) -> tuple[DataFrame, DataFrame]:
    """One micro-batch of `apply_daily_budget`, and the bytes that have arrived on every day after it.

    What arrived before enters as one row at the beginning of its day. A day ends at UTC midnight.
    """
    ts, *rest = order
    days = cut_lineage(batch.select(F.to_date(ts).alias("day")).distinct())
    kind = {f.name: f.dataType for f in batch.schema}
    carried = state.join(F.broadcast(days), "day", "left_semi")
    seeds = carried.select(
        F.col("day").cast(kind[ts]).alias(ts), *(F.lit(None).cast(kind[c]).alias(c) for c in rest),
        F.col("arrived").cast(kind[size]).alias(size), F.lit(True).alias("_seed"),
    )
    rows = batch.withColumn("_seed", F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    marked = apply_daily_budget(rows, budget, order, size).filter("NOT _seed").drop("_seed")
    arrived = batch.groupBy(F.to_date(ts).alias("day")).agg(F.sum(size).cast("bigint").alias("_more"))
    after = state.join(arrived, "day", "full_outer").select(
        "day", (F.coalesce("arrived", F.lit(0)) + F.coalesce("_more", F.lit(0))).cast("bigint").alias("arrived")
    )
    return marked, after


def stream_daily_budget(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    budget: int,
    order: Sequence[str],
    *,
    size: str = "line_bytes",
    trigger: dict[str, object] | None = None,
) -> DataStreamWriter:
    """Write every micro-batch with `over_budget` to `path/rows`, and the days' bytes to `path/state`."""

    def step(batch: DataFrame, batch_id: int) -> None:
        state = read_state(batch.sparkSession, f"{path}/state", batch_id, BUDGET_STATE)
        marked, after = budget_batch(batch, state, budget, order, size)
        marked.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        write_state(after, f"{path}/state", batch_id)

    return _writer(stream, step, checkpoint, trigger)


def stream_rate_cap(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    amount: Column,
    per_second: float,
    order: Sequence[str],
    *,
    trigger: dict[str, object] | None = None,
) -> DataStreamWriter:
    """Write every micro-batch with its `delay` behind a cap to `path/rows`, and the cap's state to `path/state`."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = read_state(spark, f"{path}/state", batch_id, CAP_STATE).first()
        spent, peak = (state.spent, state.peak) if state else (0.0, None)
        rows = rate_cap_step(batch, order, amount, per_second, "delay", spent, peak)
        rows.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        written = spark.read.schema(rows.schema).parquet(f"{path}/rows/batch_id={batch_id}")
        # One row: the largest sum and peak, or those of the batch before if this one is empty.
        ends = written.agg(F.max("_sum").alias("spent"), F.max("_peak").alias("peak"))
        kept = ends.select(F.coalesce("spent", F.lit(spent)).alias("spent"), F.coalesce("peak", F.lit(peak).cast("double")).alias("peak"))
        write_state(kept.coalesce(1), f"{path}/state", batch_id)

    return _writer(stream, step, checkpoint, trigger)
