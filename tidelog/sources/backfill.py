"""One run over the files of a past window: select, read, redact, shape, mark, write, commit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import cut_lineage
from tidelog.sources.catalogue import backfill_files, unprocessed_files
from tidelog.sources.file_runs import (
    BATCH_FILES, FilePlan, deliver_files, done_files, file_batches, findings, next_batch, read_batch, read_ledger,
)

MODES = ("label", "ingest")
KIND = "backfill"


def backfill(
    spark: SparkSession,
    files: DataFrame,
    out: str,
    *,
    since: Column | datetime | str,
    until: Column | datetime | str,
    now: Column | datetime | str,
    interval: str = "Hourly",
    types: Sequence[str] | None = None,
    mode: str = "label",
    static: Mapping[str, str] | None = None,
    plan: FilePlan | None = None,
    take_unprefixed: bool = False,
    batch_files: int = BATCH_FILES,
) -> list[str]:
    """Store the entries of all files of `[since, until)` that no run has stored; returns the types read.

    `plan` has the rules, rates, fields and org of the run. The newest version of a file counts; one that was
    regenerated after a run read it is read again and takes the place of the older entries (see
    `current_entries`). Files go to batches in the order of their creation. A run that ends in between is
    repeated from the batch it was at. Files that cannot be read are noted in `findings` and left for the
    next run. `mode` "label" keeps the true times and labels the entries; "ingest" counts them up from
    `now` for each type, in the order of the files and their rows, and keeps the true time in the metadata.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    plan = plan or FilePlan()
    plan = replace(plan, static={**plan.static, **(static or {})})
    ledger = read_ledger(spark, out)
    number = next_batch(ledger)
    wanted = backfill_files(files.filter("EventType IS NOT NULL"), since, until, types, interval)
    # Cut here: the batches of this run change the ledger.
    found = cut_lineage(unprocessed_files(wanted, done_files(ledger, plan, KIND, take_unprefixed)))
    seen: set[str] = set()
    clock: dict[str, int] = {}
    for listed in file_batches(found, batch_files):
        batch = read_batch(spark, listed)
        broken = findings(batch).filter("failed").withColumn("state", F.lit("failed")).drop("failed")
        broken.write.mode("overwrite").parquet(f"{out}/findings/batch_id={number}")
        read = [f for f in listed if batch.error(f) is None]
        deliver_files(batch, read, [], out, number, plan, KIND, now=now, mode=mode, started=clock)
        seen |= {f.EventType for f in read}
        number += 1
    return sorted(seen)
