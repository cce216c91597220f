"""Overview queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.payload import field_reader
from tidelog.functions.times import instant_for
from tidelog.operators.columns import with_once
from tidelog.operators.series import count_over_time, group_count, rate, topk, topk_per_step


def in_range(entries: DataFrame, start: object, end: object) -> DataFrame:
    """Rows of `[start, end)`, a plain filter that reaches the scan.

    Stored entries are partitioned by date; the same bounds on it skip whole folders.
    """
    first, past = instant_for(entries, "ts", start), instant_for(entries, "ts", end)
    found = entries.filter((F.col("ts") >= first) & (F.col("ts") < past))
    if "date" in entries.columns:
        found = found.filter((F.col("date") >= F.to_date(first)) & (F.col("date") <= F.to_date(past)))
    return found


def with_field(entries: DataFrame, field: str, name: str) -> DataFrame:
    """Rows whose extracted field is neither missing nor empty, with the field as a column."""
    value = field_reader(entries)(field)
    if "payload" in entries.columns:
        return entries.withColumn(name, value).filter(F.col(name) != "")
    return with_once(entries, name, value).filter(F.col(name) != "")


def events_ingested(entries: DataFrame) -> DataFrame:
    return entries.agg(F.count(F.lit(1)).alias("events"))


def event_rate(entries: DataFrame, range_seconds: float) -> DataFrame:
    return rate(entries, range_seconds).select("rate")


def active_event_types(entries: DataFrame) -> DataFrame:
    return group_count(entries, "event_type", "event_types")


def active_sources(entries: DataFrame) -> DataFrame:
    return group_count(entries, "source", "sources")


def rate_by_source(entries: DataFrame, step: str, step_seconds: float) -> DataFrame:
    return rate(entries, step_seconds, ["source"], step).drop("n")


def top_types_by_rate(entries: DataFrame, step: str, step_seconds: float, k: int = 10) -> DataFrame:
    rates = rate(entries, step_seconds, ["event_type"], step)
    return topk_per_step(rates, k, "n", ["event_type"]).drop("n")


def volume_by_type(entries: DataFrame) -> DataFrame:
    return count_over_time(entries, ["event_type"])


def events_by_org(entries: DataFrame) -> DataFrame:
    return count_over_time(entries, ["org"])


def top_clients(entries: DataFrame, k: int = 15, source: str = "eventlogfile") -> DataFrame:
    rows = with_field(entries.filter(F.col("source") == source), "CLIENT_IP", "client_ip")
    return topk(count_over_time(rows, ["client_ip"]), k, "n", ["client_ip"])


def recent_events(entries: DataFrame, n: int, row_id: str) -> DataFrame:
    """Newest rows first; a top-n per task, not a sort of the table."""
    return entries.orderBy(F.col("ts").desc(), row_id).limit(n)
