"""Rules recorded per five minutes; they run on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.payload import field_reader
from tidelog.functions.severity import LOGIN_OK
from tidelog.streaming.windows import windowed_counts

STEP = "5 minutes"


def _of_type(entries: DataFrame, event_type: str, source: str) -> DataFrame:
    return entries.filter((F.col("event_type") == event_type) & (F.col("source") == source))


def login_failed(entries: DataFrame) -> Column:
    """The status says something, and not that all went well; a missing status is no failure."""
    status = F.coalesce(field_reader(entries)("LOGIN_STATUS"), F.lit(""))
    return (status != "") & (status != LOGIN_OK)


def callout_failed(entries: DataFrame) -> Column:
    return F.coalesce(field_reader(entries)("SUCCESS"), F.lit("")) == "0"


def login_failures(
    entries: DataFrame, event_type: str = "Login", source: str = "eventlogfile"
) -> DataFrame:
    rows = _of_type(entries, event_type, source)
    return windowed_counts(rows.filter(login_failed(rows)), [], STEP)


def callout_errors(
    entries: DataFrame, event_type: str = "ApexCallout", source: str = "eventlogfile"
) -> DataFrame:
    rows = _of_type(entries, event_type, source)
    return windowed_counts(rows.filter(callout_failed(rows)), [], STEP)


def events_by_source_and_type(entries: DataFrame) -> DataFrame:
    return windowed_counts(entries, ["source", "event_type"], STEP)


def api_usage_by_family(
    entries: DataFrame, event_type: str = "ApiTotalUsage", source: str = "eventlogfile"
) -> DataFrame:
    rows = _of_type(entries, event_type, source)
    family = F.coalesce(field_reader(rows)("API_FAMILY"), F.lit(""))
    return windowed_counts(rows, [family.alias("api_family")], STEP)
