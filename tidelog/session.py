"""Session set-up and the one place where a plan's lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Session settings every job of this library expects.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpointed rows are deleted once no frame refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "tidelog", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: event times are UTC and naive columns are cast through it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder all executors share.

    It comes from `spark.checkpoint.dir`; only a local-mode session without one gets a temporary
    folder, because a machine-local folder would be lost with its executor on a cluster.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tidelog-checkpoint-")
        sc.setCheckpointDir(folder)
    return str(sc.getCheckpointDir())


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and return the written rows.

    Used where two branches of a plan must see the same range partitioning, and to keep the plans of
    later steps short.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_bytes: int = 16 << 20, written: bool = False) -> DataFrame:
    """Hint a broadcast only after the bytes of all rows were summed; a larger table is joined by shuffle.

    Meant for tables of keys and cut positions that meet a whole table of rows on a skewed key. The
    rows are written first, so that they are computed a single time, unless they were `written` already.
    """
    kept = df if written else cut_lineage(df)
    size = kept.agg(F.sum(F.octet_length(F.to_json(F.struct(*kept.columns))))).first()[0] or 0
    return F.broadcast(kept) if size <= max_bytes else kept
