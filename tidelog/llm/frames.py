"""Small DataFrame helpers the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import cut_lineage

# Rows handed to a Python task at once: texts may be long, so far fewer than the default.
BATCH_ROWS = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def modest_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of long texts takes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def written(df: DataFrame) -> DataFrame:
    """The rows, written to the folder in `spark.checkpoint.dir` and read back from there."""
    return cut_lineage(df)


# Ids sent to every task at most: 8 bytes each, so 4 MB.
SENT_IDS = 500_000
# Narrow rows a task should have at least.
TASK_ROWS = 5_000


def packed(df: DataFrame, rows: int) -> DataFrame:
    """`df`, of about `rows` rows, in no more partitions than they are worth."""
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def only(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of `df` whose `key` is in `ids`, one column of longs of that name.

    The ids are written and counted. Up to SENT_IDS of them go to every task, so that the wide rows of `df`
    need no shuffle; more are joined by shuffle.
    """
    ids = written(ids.distinct())
    few = ids.limit(SENT_IDS + 1).count() <= SENT_IDS
    return df.join(F.broadcast(ids) if few else ids, key, "left_semi")
