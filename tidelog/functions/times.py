"""Event-time parsing. Every time-relative function takes `now` as an argument."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark's own cast also takes bare times, years and padded text, so the shape is checked first.
_ISO = (
    r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?\z"
)
_COMPACT = r"\A[0-9]{14}[.][0-9]{1,6}\z"
_BASIC_DATE = r"\A[0-9]{8}\z"

# A fallback older than this is replaced by a time shortly before `now`.
MAX_FALLBACK_AGE = timedelta(hours=1)
FALLBACK_MARGIN = timedelta(minutes=5)


def instant(value: Column | datetime | str) -> Column:
    """A Column for a time given as Column, datetime or ISO text (UTC when it has no offset)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.to_timestamp(F.lit(value))
    return F.lit(value)


def instant_for(df: DataFrame, ts: str, value: Column | datetime | str) -> Column:
    """A time in the type of the column it is compared with, so that the filter reaches the scan."""
    return instant(value).cast(df.schema[ts].dataType)


def parse_event_time(text: Column) -> Column:
    """ISO-8601, `yyyyMMdd` or compact `yyyyMMddHHmmss.f` text as a UTC timestamp, else null."""
    whole = F.try_to_timestamp(F.substring(text, 1, 14), F.lit("yyyyMMddHHmmss"))
    micros = F.rpad(F.substring(text, 16, 6), 6, "0").try_cast("bigint")
    return (
        F.when(text.rlike(_ISO), text.try_cast("timestamp"))
        .when(text.rlike(_COMPACT), F.timestamp_micros(F.unix_micros(whole) + micros))
        .when(text.rlike(_BASIC_DATE), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    )


def epoch_millis_time(millis: Column) -> Column:
    """A numeric value (by type, never numeric text) is milliseconds since the epoch."""
    return F.timestamp_micros(F.round(millis.cast("double") * 1000).cast("bigint"))


def parse_variant_time(payload: Column, path: str) -> Column:
    """Time at `path` of a VARIANT payload: numbers are epoch millis, text is parsed."""
    value = F.try_variant_get(payload, path, "variant")
    kind = F.schema_of_variant(value)
    return F.when(
        kind.rlike(r"\A(BIGINT|DOUBLE|FLOAT|DECIMAL.*)\z"),
        epoch_millis_time(F.try_variant_get(payload, path, "double")),
    ).otherwise(parse_event_time(F.try_variant_get(payload, path, "string")))


def extract_event_time(
    candidates: Sequence[Column], fallback: Column | None, now: Column | datetime | str
) -> tuple[Column, Column]:
    """`(ts, used_fallback)`: the first candidate that parsed, else a fallback near `now`."""
    now = instant(now)
    best = F.coalesce(*candidates)
    if fallback is None:
        spare = now
    else:
        stale = fallback < now - F.expr(f"INTERVAL {int(MAX_FALLBACK_AGE.total_seconds())} SECOND")
        near = now - F.expr(f"INTERVAL {int(FALLBACK_MARGIN.total_seconds())} SECOND")
        spare = F.when(stale, near).otherwise(F.coalesce(fallback, now))
    return F.coalesce(best, spare), best.isNull()


def utc_literal(text: Column) -> Column:
    """Any parseable time as `yyyy-MM-ddTHH:mm:ss.SSSZ`; other text unchanged."""
    parsed = parse_event_time(text)
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), text)


def iso_micros(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def epoch_nanos(ts: Column) -> Column:
    """Nanoseconds since the epoch, as text."""
    return (F.unix_micros(ts) * 1000).cast("string")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)
