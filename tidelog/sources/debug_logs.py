"""Debug logs: a metadata table joined to the bodies that are small enough."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.labels import merge_maps, text_map
from tidelog.functions.payload import canonical_line
from tidelog.functions.times import extract_event_time, parse_event_time
from tidelog.operators.shape import debug_log_metadata, promote_metadata

# The metadata fields of a debug log.
META_FIELDS = (
    "Id", "LogUserId", "LogLength", "Operation", "Request", "Status", "StartTime", "Application",
    "DurationMilliseconds", "Location",
)


def logs_of_users(meta: DataFrame, users: Sequence[str] = (), col: str = "Username") -> DataFrame:
    """Logs of the named users; an empty list means all."""
    return meta.filter(F.col(col).isin(*users)) if users else meta


def body_files(spark: SparkSession, paths: Sequence[str], max_bytes: int | None = None) -> DataFrame:
    """`(Id, body)` of whole text files named `<Id>.log`; with `max_bytes`, larger files are not read."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"\A(.*?)(?:[.][^.]*)?\z", 1)
    files = spark.read.text(list(paths), wholetext=True)
    if max_bytes is not None:
        files = files.filter(F.col("_metadata.file_size") <= max_bytes)
    return files.select(name.alias("Id"), F.col("value").alias("body"))


def logs_with_bodies(meta: DataFrame, bodies: DataFrame, max_body_bytes: int) -> DataFrame:
    """`meta` with `body` and `skip_reason`.

    Only logs of an allowed length meet the bodies, and only bodies of an allowed size: the rest of
    either side is not moved. A log longer than `max_body_bytes` or of unknown length is skipped for
    its `size`, one without a body for its `download_error`.
    """
    small = F.coalesce(F.col("LogLength") <= max_body_bytes, F.lit(False))
    near = bodies.filter(F.octet_length("body") <= max_body_bytes)
    joined = meta.filter(small).join(near, "Id", "left").withColumn(
        "skip_reason", F.when(F.col("body").isNull(), F.lit("download_error"))
    )
    large = meta.filter(~small).withColumns(
        {"body": F.lit(None).cast("string"), "skip_reason": F.lit("size")}
    )
    return joined.unionByName(large)


def read_debug_logs(
    meta: DataFrame,
    bodies: DataFrame,
    max_body_bytes: int,
    *,
    now: Column | datetime | str,
    fallback: Column | None = None,
    metadata_fields: Sequence[str] = (),
) -> DataFrame:
    """Entries of debug logs.

    A log without a usable body ships its metadata as the line and says why (`size` or
    `download_error`).
    """
    fields = {f: F.col(f) for f in META_FIELDS if f in meta.columns}
    joined = logs_with_bodies(meta, bodies, max_body_bytes)
    reason = F.col("skip_reason")
    payload = text_map(fields)
    skipped = text_map(
        {"body_skipped": F.when(reason.isNotNull(), F.lit("true")), "body_skip_reason": reason}
    )
    ts, used_fallback = extract_event_time([parse_event_time(F.col("StartTime"))], fallback, now)
    metadata = debug_log_metadata(fields, promote_metadata(payload, metadata_fields))
    return joined.select(
        F.col("Id").alias("log_id"),
        ts.alias("ts"),
        text_map({"source": F.lit("apexlog"), "event_type": F.lit("apexlog")}).alias("labels"),
        F.when(reason.isNull(), F.col("body")).otherwise(canonical_line(payload)).alias("line"),
        merge_maps(metadata, skipped).alias("metadata"),
        reason.alias("skip_reason"),
        used_fallback.alias("used_fallback"),
    )
