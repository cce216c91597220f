"""Alert conditions over event time and over metric tables.

Metric frames have `(ts, name, attrs, value, le)`; a counter row holds the increase at its time, a
gauge row its current value.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.functions.labels import stream_key
from tidelog.functions.times import instant, seconds_between
from tidelog.operators.alerts import pending_alerts
from tidelog.operators.series import (
    floored_ratio,
    histogram,
    histogram_quantile,
    step_of,
    trailing_counts,
    vector_ratio,
)

from tidelog.plans.recording import _of_type, callout_failed, login_failed


def login_failure_spike(
    entries: DataFrame,
    threshold: int = 10,
    range_minutes: int = 10,
    hold_minutes: int = 5,
    tick_minutes: int = 1,
    event_type: str = "Login",
    source: str = "eventlogfile",
) -> DataFrame:
    rows = _of_type(entries, event_type, source)
    ticks = trailing_counts(rows.filter(login_failed(rows)), range_minutes, tick_minutes)
    return pending_alerts(ticks, F.col("n") > threshold, hold_minutes, tick_minutes)


def callout_error_rate(
    entries: DataFrame,
    range_minutes: int = 10,
    tick_minutes: int = 1,
    event_type: str = "ApexCallout",
    source: str = "eventlogfile",
) -> DataFrame:
    """Percent of failed callouts at every evaluation."""
    rows = _of_type(entries, event_type, source)
    measures = {"errors": F.when(callout_failed(rows), 1).otherwise(0), "calls": F.lit(1)}
    ticks = trailing_counts(rows, range_minutes, tick_minutes, measures=measures)
    return ticks.withColumn("percent", F.col("errors") / F.col("calls") * 100)


def callout_error_alerts(
    entries: DataFrame,
    threshold: float = 10.0,
    range_minutes: int = 10,
    hold_minutes: int = 5,
    tick_minutes: int = 1,
) -> DataFrame:
    ticks = callout_error_rate(entries, range_minutes, tick_minutes)
    return pending_alerts(ticks, F.col("percent") > threshold, hold_minutes, tick_minutes)


def headroom(limits: DataFrame, on: list[str]) -> DataFrame:
    """Remaining share of every limit; `limits` has `max` and `remaining`, divided in the row."""
    return limits.select(*on, F.try_divide(F.col("remaining").cast("double"), F.col("max").cast("double")).alias("ratio"))


def api_headroom_low(limits: DataFrame, percent: float = 10.0, by: list[str] | None = None) -> DataFrame:
    """The lowest headroom of all limits, in percent, and whether it is below the threshold."""
    lowest = headroom(limits, by or []).groupBy(*(by or [])).agg((F.min("ratio") * 100).alias("min_percent"))
    return lowest.withColumn("firing", F.col("min_percent") < percent)


def ingest_lag_high(
    entries: DataFrame,
    lag: Column,
    step: str = "5 minutes",
    q: float = 0.95,
    threshold: float = 900.0,
) -> DataFrame:
    """Lag quantile per step and source; sources are kept apart because files are hours late."""
    steps = entries.withColumn("step_start", step_of(F.col("ts"), step))
    by = ["step_start", "source"]
    found = histogram_quantile(histogram(steps, lag, by), q, by)
    return found.withColumn("firing", F.col("quantile") > threshold)


def delivery_failing(
    pushes: DataFrame, success: Column, step_minutes: int = 5, percent: float = 5.0
) -> DataFrame:
    """Share of pushes that did not succeed, per step; the floor is a rate per second."""
    seconds = F.lit(60.0 * step_minutes)
    step = step_of(F.col("ts"), f"{step_minutes} minutes")
    per_step = pushes.groupBy(step.alias("step_start")).agg(
        (F.sum(F.when(~success, 1).otherwise(0)) / seconds).alias("_failed"),
        (F.count(F.lit(1)) / seconds).alias("_all"),
    )
    share = floored_ratio(F.col("_failed"), F.col("_all"), 0.0001, 100.0)
    return per_step.select("step_start", share.alias("percent")).withColumn(
        "firing", F.col("percent") > percent
    )


def no_recent_delivery(
    deliveries: DataFrame, now: Column | datetime | str, max_seconds: float = 600.0
) -> DataFrame:
    """Seconds since the last successful delivery; `deliveries` holds the successful ones."""
    last = deliveries.agg(F.max("ts").alias("last_success"))
    age = seconds_between(instant(now), F.col("last_success"))
    return last.withColumn("age_seconds", age).withColumn("firing", F.col("age_seconds") > max_seconds)


def writer_count_anomaly(gauge: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Active writers per evaluation and how far their number is from one."""
    total = gauge.groupBy(*(by or [])).agg(F.sum("value").alias("writers"))
    return total.withColumn("deviation", F.abs(F.col("writers") - 1)).withColumn(
        "firing", F.col("deviation") > 0
    )


# --- rules over metric frames -------------------------------------------------------------------


def series(metrics: DataFrame, name: str, **attrs: str) -> DataFrame:
    """The rows of one metric whose attributes have the given values."""
    rows = metrics.filter(F.col("name") == name)
    for key, value in attrs.items():
        rows = rows.filter(F.col("attrs").getItem(key) == value)
    return rows


def sampled_gauge(rows: DataFrame, tick_minutes: int, stale_minutes: int) -> DataFrame:
    """(tick, attrs as text, value): the newest value of every series at each tick.

    A series counts until its newest value is `stale_minutes` old. Values are reduced to one per
    series and tick before they are copied to the ticks that still see them.
    """
    tick = F.expr(f"INTERVAL {tick_minutes} MINUTE")
    per_tick = rows.groupBy(
        step_of(F.col("ts"), f"{tick_minutes} minutes").alias("_at"), stream_key(F.col("attrs")).alias("series")
    ).agg(F.max_by("value", "ts").alias("value"))
    seen = F.sequence(F.col("_at") + tick, F.col("_at") + F.expr(f"INTERVAL {max(stale_minutes, tick_minutes)} MINUTE"), tick)
    return (
        per_tick.withColumn("tick", F.explode(seen))
        .groupBy("tick", "series")
        .agg(F.max_by("value", "_at").alias("value"))
    )


def api_headroom_alerts(
    metrics: DataFrame,
    remaining: str,
    maximum: str,
    percent: float = 10.0,
    hold_minutes: int = 5,
    tick_minutes: int = 1,
    stale_minutes: int = 5,
    **attrs: str,
) -> DataFrame:
    """Spans in which the lowest share of any limit stays below the threshold."""
    left, right = (
        sampled_gauge(series(metrics, name, **attrs), tick_minutes, stale_minutes) for name in (remaining, maximum)
    )
    ticks = vector_ratio(left, right, ["tick", "series"]).groupBy("tick").agg((F.min("ratio") * 100).alias("percent"))
    return pending_alerts(ticks, F.col("percent") < percent, hold_minutes, tick_minutes)


def ingest_lag_alerts(
    metrics: DataFrame,
    buckets: str,
    q: float = 0.95,
    threshold: float = 900.0,
    range_minutes: int = 5,
    hold_minutes: int = 10,
    tick_minutes: int = 1,
    **attrs: str,
) -> DataFrame:
    """Spans in which the lag quantile over the range before each tick stays above the threshold.

    `buckets` is a histogram counter: the increase of rows with a lag up to `le` (infinity: all).
    """
    rows = series(metrics, buckets, **attrs)
    counts = trailing_counts(rows, range_minutes, tick_minutes, ["le"], {"n": F.col("value")})
    ticks = histogram_quantile(counts, q, ["tick"])
    return pending_alerts(ticks, F.col("quantile") > threshold, hold_minutes, tick_minutes)


def delivery_failing_alerts(
    metrics: DataFrame,
    pushes: str,
    percent: float = 5.0,
    range_minutes: int = 5,
    hold_minutes: int = 5,
    tick_minutes: int = 1,
    **attrs: str,
) -> DataFrame:
    """Spans in which the share of pushes of another outcome than success stays above the threshold."""
    rows = series(metrics, pushes, **attrs)
    failed = F.when(F.coalesce(F.col("attrs").getItem("outcome") != "success", F.lit(True)), F.col("value")).otherwise(0)
    counts = trailing_counts(rows, range_minutes, tick_minutes, measures={"failed": failed, "n": F.col("value")})
    seconds = 60.0 * range_minutes
    share = floored_ratio(F.col("failed") / seconds, F.col("n") / seconds, 0.0001, 100.0)
    return pending_alerts(counts.withColumn("percent", share), F.col("percent") > percent, hold_minutes, tick_minutes)


def no_recent_delivery_alerts(
    deliveries: DataFrame,
    until: Column | datetime | str,
    max_seconds: float = 600.0,
    hold_minutes: int = 5,
    tick_minutes: int = 1,
) -> DataFrame:
    """Spans of ticks, up to `until`, at which the last successful delivery is too long ago.

    Deliveries are reduced to the newest of every tick. The ticks between two of them follow from the
    gap, so a span is computed without a row for every tick: it runs from the first tick more than
    `max_seconds` after a delivery to the last tick before the next one is seen.
    """
    spacing = 60 * tick_minutes
    last_tick = F.floor(F.unix_seconds(instant(until).cast("timestamp")) / spacing) * spacing
    per_tick = deliveries.groupBy(
        step_of(F.col("ts"), f"{tick_minutes} minutes").alias("_at")
    ).agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("_last"))
    # At most one row a tick; every row looks at the next one.
    following = F.lead("_last").over(W.partitionBy(F.lit(0)).orderBy("_last"))
    gaps = per_tick.select("_last", following.alias("_next"))
    first = (F.floor((F.col("_last") + max_seconds) / spacing) + 1) * spacing
    end = F.least(F.coalesce(F.ceil(F.col("_next") / spacing) * spacing - spacing, last_tick), last_tick)
    spans = gaps.select(first.alias("_first"), end.alias("_end")).filter("_end >= _first")
    time = lambda seconds: F.timestamp_seconds(seconds)
    return spans.filter(F.col("_end") - F.col("_first") >= 60 * hold_minutes).select(
        time(F.col("_first")).alias("pending_since"),
        time(F.col("_first") + 60 * hold_minutes).alias("firing_at"),
        time(F.col("_end")).alias("last_true"),
        ((F.col("_end") - F.col("_first")) / spacing + 1).cast("bigint").alias("ticks"),
    )


def writer_count_alerts(
    metrics: DataFrame,
    gauge: str,
    hold_minutes: int = 5,
    tick_minutes: int = 1,
    stale_minutes: int = 5,
    **attrs: str,
) -> DataFrame:
    """Spans in which the number of active writers is not one."""
    ticks = sampled_gauge(series(metrics, gauge, **attrs), tick_minutes, stale_minutes).groupBy("tick").agg(
        F.sum("value").alias("writers")
    )
    return pending_alerts(ticks, F.abs(F.col("writers") - 1) > 0, hold_minutes, tick_minutes)
