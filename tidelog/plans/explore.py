"""Queries on single event types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.payload import field_reader
from tidelog.operators.series import average, count_over_time, group_count, quantiles, rate
from tidelog.plans.dashboard import with_field


def login_status_breakdown(entries: DataFrame, event_type: str = "Login") -> DataFrame:
    rows = entries.filter(F.col("event_type") == event_type)
    return count_over_time(with_field(rows, "LOGIN_STATUS", "login_status"), ["login_status"])


def country_count(entries: DataFrame, field: str = "COUNTRY") -> DataFrame:
    return group_count(with_field(entries, field, "country"), "country", "countries")


def events_by_country(entries: DataFrame, field: str = "COUNTRY") -> DataFrame:
    return count_over_time(with_field(entries, field, "country"), ["country"])


def callout_latency(
    entries: DataFrame,
    event_type: str = "ApexCallout",
    field: str = "TIME",
    qs: tuple[float, ...] = (0.5, 0.95, 0.99),
) -> DataFrame:
    """Exact quantiles of an extracted duration; blank values do not count."""
    rows = entries.filter(F.col("event_type") == event_type)
    return quantiles(rows, field_reader(rows)(field).try_cast("double"), qs, ["event_type"])


def db_time_by_type(entries: DataFrame, field: str = "DB_TOTAL_TIME") -> DataFrame:
    return average(entries, field_reader(entries)(field), ["event_type"])


def drop_rate_by_type(dropped: DataFrame, step: str, step_seconds: float) -> DataFrame:
    """Rate of rows a rule dropped, per type and step; `dropped` holds the dropped rows."""
    return rate(dropped, step_seconds, ["event_type"], step).drop("n")
