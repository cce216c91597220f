"""Resume positions: an append-only ledger, cursors, and what a cursor selects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.globs import matches_glob
from tidelog.functions.times import instant, parse_event_time
from tidelog.schema import PROGRESS_SCHEMA
from tidelog.session import broadcast_if_small, cut_lineage


def commit_progress(tokens: DataFrame, path: str, batch_id: int) -> None:
    """Append `(key, value, seq)` rows, the last token of every key, under the batch's own folder.

    Call it after the batch's data is written. Writing a batch again replaces its own rows.
    """
    last_token_per_key(tokens).withColumn("deleted", F.lit(False)).select(
        "key", "value", "seq", "deleted"
    ).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def last_token_per_key(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("key").agg(
        F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq")
    )


LEDGER = f"{PROGRESS_SCHEMA}, batch_id bigint"


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the batches that whole snapshots reach up to, ascending."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}-snapshots")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    found = [s.getPath() for s in system.listStatus(folder)]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(p.getName().partition("=")[2]) for p in found if system.exists(done(p, "_SUCCESS")))


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The ledger under `path`: its newest snapshot and the batches after it, whose folders alone are read."""
    newest = (_snapshots(spark, path) or [None])[-1]
    try:
        tail = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException:
        tail = spark.createDataFrame([], LEDGER)
    if newest is None:
        return tail
    snapshot = spark.read.schema(PROGRESS_SCHEMA).parquet(f"{path}-snapshots/upto={newest}")
    return snapshot.withColumn("batch_id", F.lit(newest).cast("bigint")).unionByName(tail.filter(F.col("batch_id") > newest))


def compact_progress(spark: SparkSession, path: str) -> int | None:
    """Write the current row of every key as a snapshot that takes the place of all batches so far.

    Deleted keys are left out. A snapshot counts once it is complete, so one that ended in between changes
    nothing, and writing it again gives the same. Batches are not removed: one that is replayed rewrites its own
    folder, which the snapshot already covers. Returns the last batch it covers.
    """
    ledger = cut_lineage(read_progress(spark, path))
    upto = ledger.agg(F.max("batch_id")).first()[0]
    if upto is None or upto in _snapshots(spark, path):
        return upto
    last = ledger.groupBy("key").agg(F.max_by(F.struct("value", "seq", "deleted"), F.struct("seq", "batch_id")).alias("_last"))
    kept = last.filter(~F.col("_last.deleted")).select("key", "_last.*")
    kept.write.mode("overwrite").parquet(f"{path}-snapshots/upto={upto}")
    return upto


def show_progress(ledger: DataFrame, key_glob: str = "*") -> DataFrame:
    """Current value per key: the last row wins, a tombstone removes the key."""
    return (
        ledger.filter(matches_glob(F.col("key"), key_glob))
        .groupBy("key")
        .agg(F.max_by(F.struct("value", "deleted"), "seq").alias("_last"))
        .filter(~F.col("_last.deleted"))
        .select("key", F.col("_last.value").alias("value"))
    )


def _with_edit(ledger: DataFrame, keys: Mapping[str, str | None]) -> DataFrame:
    spark = ledger.sparkSession
    edits = spark.createDataFrame(
        [(k, v, v is None) for k, v in keys.items()], "key string, value string, deleted boolean"
    )
    following = ledger.agg((F.coalesce(F.max("seq"), F.lit(0)) + 1).alias("seq")).scalar()
    return ledger.unionByName(edits.withColumn("seq", following), allowMissingColumns=True)


def set_progress(ledger: DataFrame, key: str, value: str) -> DataFrame:
    """The ledger with a repaired position."""
    return _with_edit(ledger, {key: value})


def delete_progress(ledger: DataFrame, key: str) -> DataFrame:
    """The ledger without a position for the key: its source restarts from its lookback."""
    return _with_edit(ledger, {key: None})


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PROGRESS_SCHEMA)


def valid_cursor(stored: Column, now: Column | datetime | str, lookback: str) -> Column:
    """Watermark of a stored cursor: JSON with `last_ts` or a bare time; else now - lookback."""
    kind = F.schema_of_variant(F.try_parse_json(stored))
    nested = F.get_json_object(stored, "$.last_ts")
    text = F.when(kind.startswith("OBJECT"), nested).otherwise(stored)
    return F.coalesce(
        parse_event_time(text), instant(now) - F.expr(f"INTERVAL {lookback}")
    )


def next_cursor(rows: DataFrame, by: Sequence[str], ts: str, row_id: str) -> DataFrame:
    """Watermark per key after a read: the largest valid time and its largest id.

    Feed it the rows before any filter or sampling: dropped rows move the cursor, too. A missing
    time never does.
    """
    return (
        rows.filter(F.col(ts).isNotNull())
        .groupBy(*by)
        .agg(F.max(F.struct(F.col(ts).alias("watermark"), F.col(row_id).alias("last_id"))).alias("_c"))
        .select(*by, "_c.*")
    )


def boundary_ids(rows: DataFrame, cursor: DataFrame, by: Sequence[str], ts: str, row_id: str) -> DataFrame:
    """All ids at the watermark instant, one row each, to be skipped by the next read."""
    marks = broadcast_if_small(cursor.select(*by, "watermark"))
    return rows.join(marks, list(by)).filter(F.col(ts) == F.col("watermark")).select(*by, row_id)


def org_prefix(name: str) -> str:
    return f"org={name}:"


def prefix_keys(tokens: DataFrame, org: str) -> DataFrame:
    """Progress keys of one org, apart from those of the others."""
    return tokens.withColumn("key", F.concat(F.lit(org_prefix(org)), F.col("key")))


def org_progress(ledger: DataFrame, org: str, keys: DataFrame, take_unprefixed: bool = False) -> DataFrame:
    """Position per key of one org; the first org may take over keys from before orgs had names."""
    current = show_progress(ledger)
    own = current.select(F.col("key").alias("_own"), F.col("value").alias("_own_value"))
    found = keys.join(own, F.concat(F.lit(org_prefix(org)), F.col("key")) == F.col("_own"), "left")
    value = F.col("_own_value")
    if take_unprefixed:
        old = current.select("key", F.col("value").alias("_old_value"))
        found = found.join(old, "key", "left")
        value = F.coalesce(value, F.col("_old_value"))
    return found.select("key", value.alias("value"))
