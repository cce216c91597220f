"""One cycle over a live file catalogue: list, settle, read, hold or abandon, shape, commit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.times import instant
from tidelog.session import cut_lineage
from tidelog.sources.catalogue import settled_only, split_unreadable, unprocessed_files, with_created
from tidelog.sources.file_runs import (
    BATCH_FILES, FilePlan, deliver_files, done_files, file_batches, findings, next_batch, read_batch, read_ledger,
)

KIND = "eventlogfile"


@dataclass(frozen=True)
class Cycle:
    """What one cycle did: files read, held back, given up, and without a row yet."""

    read: int
    held: int
    abandoned: int
    empty: int


def poll_files(
    spark: SparkSession,
    files: DataFrame,
    out: str,
    plan: FilePlan,
    *,
    now: Column | datetime | str,
    interval: str = "Hourly",
    types: Sequence[str] | None = None,
    lookback: str = "1 DAY",
    settle_minutes: float | None = None,
    max_age_hours: float = 24,
    take_unprefixed: bool = False,
    batch_files: int = BATCH_FILES,
) -> Cycle:
    """Store the entries of all settled files no cycle has stored, and move the positions over them.

    A file that cannot be read holds back itself and the later files of its type while it is younger than
    `max_age_hours`; then it is given up: its position is committed without entries. Held files and files
    without a row keep no position and are tried by the next cycle. All broken files are written to `findings`
    with their error and state. Files are those created since `now - lookback`, dated ones only.
    """
    ledger = read_ledger(spark, out)
    number = next_batch(ledger)
    edge = instant(now) - F.expr(f"INTERVAL {lookback}")
    listed = with_created(files.filter((F.col("Interval") == interval) & F.col("EventType").isNotNull()))
    if types:
        listed = listed.filter(F.col("EventType").isin(*types))
    fresh = unprocessed_files(listed.filter(F.col("created") >= edge), done_files(ledger, plan, KIND, take_unprefixed))
    settled = cut_lineage(settled_only(fresh, now, settle_minutes, interval))
    read = held = abandoned = empty = 0
    stopped: set[str] = set()
    for rows in file_batches(settled, batch_files):
        batch = read_batch(spark, rows)
        states = split_unreadable(findings(batch), now, max_age_hours)
        # A type that an earlier batch of this cycle held back stays held; batches are in the order of creation.
        if stopped:
            states = states.withColumn("state", F.when(F.col("EventType").isin(*stopped), F.lit("held")).otherwise(F.col("state")))
        marked = cut_lineage(states)
        # One row a file of the batch.
        state = {r.Id: r.state for r in marked.collect()}
        marked.filter("error IS NOT NULL").drop("failed").write.mode("overwrite").parquet(f"{out}/findings/batch_id={number}")
        good = [f for f in rows if state[f.Id] == "read"]
        given_up = [f for f in rows if state[f.Id] == "abandoned"]
        deliver_files(batch, good, given_up, out, number, plan, KIND, now=now)
        stopped |= {f.EventType for f in rows if state[f.Id] == "held"}
        blank = sum(batch.rows(f) == 0 for f in good)
        read, empty = read + len(good) - blank, empty + blank
        held, abandoned = held + sum(s == "held" for s in state.values()), abandoned + len(given_up)
        number += 1
    return Cycle(read, held, abandoned, empty)
