"""The entry sink: replay-safe writes, rejects on the side, progress last."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidelog.functions.labels import disallowed_labels
from tidelog.functions.text import line_bytes
from tidelog.operators.columns import with_once
from tidelog.operators.progress import commit_progress
from tidelog.schema import ALLOWED_LABELS

# What `store_new` adds to the entries it writes.
ENTRY_NAME = "entry_name"


def reject_reason(max_line_bytes: int = 262_144, allowed: Sequence[str] = ALLOWED_LABELS) -> Column:
    """Why an entry cannot be delivered, or null."""
    return (
        F.when(F.col("ts").isNull(), F.lit("no_time"))
        .when(F.col("line").isNull(), F.lit("no_line"))
        .when(line_bytes(F.col("line")) > max_line_bytes, F.lit("oversized"))
        .when(F.size(disallowed_labels(F.col("labels"), allowed)) > 0, F.lit("bad_label"))
    )


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Deliverable rows, and rejected rows with their `reject_reason`."""
    marked = with_once(df, "reject_reason", reason)
    good = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.filter(F.col("reject_reason").isNotNull())


def reject_counts(df: DataFrame, reason: Column) -> DataFrame:
    return split_rejects(df, reason)[1].groupBy("reject_reason").agg(F.count("*").alias("n"))


def write_entries(df: DataFrame, path: str, batch_id: int) -> None:
    """Parquet by event type and date under the batch's own folder.

    A replayed batch overwrites exactly what it wrote before. Label and field columns that queries
    filter on are kept as columns next to the line.
    """
    out = df.withColumn("date", F.to_date("ts"))
    if "event_type" not in df.columns:
        out = out.withColumn("event_type", F.col("labels").getItem("event_type"))
    # Few files per folder: small folders share a task, and a hot one is split over several.
    out.hint("rebalance", "event_type", "date").write.mode("overwrite").partitionBy(
        "event_type", "date"
    ).parquet(f"{path}/batch_id={batch_id}")


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Stored entries of all batches, with `event_type` and `date` as partition columns.

    `source` and `org` come back as columns from the labels, which is what the query pack groups by.
    """
    stored = spark.read.parquet(path).drop(ENTRY_NAME)
    own = {c: F.col("labels").getItem(c) for c in ("source", "org") if c not in stored.columns}
    return stored.withColumns(own)


def deliver_batch(
    df: DataFrame,
    batch_id: int,
    path: str,
    *,
    reason: Column | None = None,
    tokens: DataFrame | None = None,
    counted: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    """Write entries, then rejects, then progress: positions advance only over durable rows.

    `counted` is an observation and the aggregates it takes of all rows on their way to the sink.
    """
    # Written in two parts, so the shaped batch is kept instead of computed twice.
    kept = df.persist()
    try:
        rows = kept.observe(counted[0], *counted[1]) if counted else kept
        good, bad = split_rejects(rows, reject_reason() if reason is None else reason)
        write_entries(good, f"{path}/entries", batch_id)
        bad.write.mode("overwrite").parquet(f"{path}/rejects/batch_id={batch_id}")
    finally:
        kept.unpersist()
    if tokens is not None:
        commit_progress(tokens, f"{path}/progress", batch_id)


def stream_entries(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    progress: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict[str, object] | None = None,
    pool: str | None = None,
    counted: Sequence[Column] = (),
) -> DataStreamWriter:
    """A writer that shapes and delivers every micro-batch; call `.start()` on it.

    `counted` are named aggregates of the shaped rows. They are observed on the way to the sink, without a pass
    of their own, and written as one row a batch to `path/outcomes`; a replayed batch replaces its row.

    `progress` computes ledger tokens from the rows as they arrived, so a batch whose rows are all
    filtered out still advances. The trigger is the flush interval (default: all there is, then
    stop); the size limits of a flush are those of the source.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        if pool:
            batch.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        # The source is read once for the rows and their positions.
        arrived = batch.persist() if progress else batch
        try:
            tokens = progress(arrived) if progress else None
            if not counted:
                deliver_batch(shape(arrived), batch_id, path, tokens=tokens)
                return
            seen = Observation()
            deliver_batch(shape(arrived), batch_id, path, tokens=tokens, counted=(seen, counted))
        finally:
            if progress:
                arrived.unpersist()
        row = [F.lit(value).alias(name) for name, value in seen.get.items()]
        batch.sparkSession.range(1).select(*row).write.mode("overwrite").parquet(f"{path}/outcomes/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True}))
