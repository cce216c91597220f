"""Daily byte budgets and rate caps."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.operators.running import SLICE, running, slice_ordered
from tidelog.session import broadcast_if_small, cut_lineage

DAY = "_day"


def _with_day(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(DAY, F.to_date(F.col(ts)))


def crossings(df: DataFrame, limits: Sequence[float], order: Sequence[str], size: str) -> DataFrame:
    """Per day and limit, `cut`: the first row whose running size reaches the limit.

    `order` starts with the time. Minute totals find the minute of the crossing, so only the rows of
    those minutes are put in order, not the whole table.
    """
    ts = order[0]
    narrow = _with_day(df.select(*order, F.col(size).cast("bigint").alias("_size")), ts).withColumn(
        "_minute", F.date_trunc("minute", F.col(ts))
    )
    minutes = narrow.groupBy(DAY, "_minute").agg(F.sum("_size").alias("_size"))
    upto = W.partitionBy(DAY).orderBy("_minute").rowsBetween(W.unboundedPreceding, 0)
    minutes = minutes.withColumn("_upto", F.sum("_size").over(upto))
    marks = F.explode(F.array(*(F.lit(float(x)) for x in limits)))
    crossing = (
        minutes.withColumn("limit", marks)
        .filter(F.col("_upto") >= F.col("limit"))
        .groupBy(DAY, "limit")
        .agg(F.min(F.struct("_minute", (F.col("_upto") - F.col("_size")).alias("_before"))).alias("_m"))
        .select(DAY, "limit", "_m.*")
    )
    candidates = narrow.join(broadcast_if_small(crossing), [DAY, "_minute"])
    sliced = slice_ordered(candidates, [DAY, "limit"], order)
    used = running(sliced, [DAY, "limit"], order, {"_used": ("sum", F.col("_size"))})
    reached = used.filter(F.col("_before") + F.col("_used") >= F.col("limit"))
    position = F.struct(*[F.col(c) for c in order])
    return reached.groupBy(DAY, "limit").agg(F.min(position).alias("cut"))


def _beyond(budget: float) -> float:
    """The least whole number of bytes that no longer fits."""
    return float(math.floor(budget) + 1)


def _marked(df: DataFrame, cuts: DataFrame, order: Sequence[str]) -> DataFrame:
    position = F.struct(*[F.col(c) for c in order])
    return (
        _with_day(df, order[0])
        .join(broadcast_if_small(cuts), DAY, "left")
        .withColumn("over_budget", F.coalesce(position >= F.col("cut"), F.lit(False)))
        .drop("cut")
    )


def apply_daily_budget(
    df: DataFrame, budget: int, order: Sequence[str], size: str = "line_bytes"
) -> DataFrame:
    """Add `over_budget`: true from the first row of a UTC day that no longer fits its budget.

    Rows are kept while the day's running size stays within the budget. The rows themselves are not
    shuffled; they only meet the table of one cut position per day.
    """
    cuts = crossings(df, [_beyond(budget)], order, size).select(DAY, "cut")
    return _marked(df, cuts, order).drop(DAY)


def hold_over_budget(
    df: DataFrame, budget: int, order: Sequence[str], size: str = "line_bytes"
) -> DataFrame:
    """Add `deliver_on`: the UTC day a row is delivered when over-budget rows wait in line.

    First in, first out: every day delivers `budget` bytes of backlog and new rows together. What
    waits when a day begins follows from the totals of the days with arrivals: with A bytes before
    day number n, the line gains A - budget * n, and its length is that gain above its lowest value so
    far. A row that ends x bytes into the line leaves on day n + ceil(x / budget) - 1, so days without
    arrivals and the drain after the last one need no rows.
    """
    ts = order[0]
    dated = _with_day(df, ts)
    totals = dated.groupBy(DAY).agg(F.sum(size).alias("_arrived"))
    # One row per day with arrivals.
    line = W.orderBy(DAY)
    earlier = line.rowsBetween(W.unboundedPreceding, -1)
    upto = line.rowsBetween(W.unboundedPreceding, 0)
    number = F.datediff(DAY, F.min(DAY).over(W.partitionBy()))
    gain = F.coalesce(F.sum("_arrived").over(earlier), F.lit(0)) - F.lit(budget) * number
    waiting = totals.withColumn("_gain", gain).select(
        F.col(DAY).alias("_on"), (F.col("_gain") - F.least(F.lit(0), F.min("_gain").over(upto))).alias("_waiting")
    )
    sliced = slice_ordered(dated, [DAY], order)
    rows = running(sliced, [DAY], order, {"_today": ("sum", F.col(size))})
    days = F.ceil((F.col("_waiting") + F.coalesce("_today", F.lit(0))) / F.lit(budget)) - 1
    return (
        rows.join(broadcast_if_small(waiting), F.col(DAY) == F.col("_on"), "left")
        .withColumn("deliver_on", F.date_add(DAY, F.greatest(days, F.lit(0)).cast("int")))
        .drop(DAY, "_on", "_waiting", "_today", SLICE)
    )


def budget_report(
    df: DataFrame, budget: int, order: Sequence[str], size: str = "line_bytes", warn_at: float = 0.8
) -> DataFrame:
    """Per UTC day: bytes kept and dropped, and when the use reached the warning share."""
    ts = order[0]
    share = float(warn_at * budget)
    over = _beyond(budget)
    # One row per day and limit, read for the cut and for the warning.
    found = cut_lineage(crossings(df, sorted({over, share}), order, size))
    cuts = found.filter(F.col("limit") == over).select(DAY, "cut")
    totals = _marked(df, cuts, order).groupBy(DAY).agg(
        F.sum(F.when(~F.col("over_budget"), F.col(size)).otherwise(0)).alias("used_bytes"),
        F.sum(F.when(F.col("over_budget"), F.col(size)).otherwise(0)).alias("dropped_bytes"),
        F.count_if("over_budget").alias("dropped_rows"),
    )
    warned = found.filter(F.col("limit") == share).select(DAY, F.col(f"cut.{ts}").alias("reached_at"))
    # A row that no longer fits is not charged, so the warning needs the kept bytes to get there.
    return (
        totals.join(warned, DAY, "left")
        .withColumn("warned_at", F.when(F.col("used_bytes") >= share, F.col("reached_at")))
        .withColumnRenamed(DAY, "day")
        .drop("reached_at")
    )


def rate_cap_lag(
    df: DataFrame, order: Sequence[str], amount: Column, per_second: float, name: str = "delay"
) -> DataFrame:
    """Seconds each row would wait behind a cap of `per_second`, with one second of burst.

    With arrival A and running amount over rate S, a row leaves at F = S + max(A_k - S_{k-1}) over
    the rows so far, and waits max(0, F - 1 - A). That is a token bucket as long as one row's amount
    fits into it.
    """
    return rate_cap_step(df, order, amount, per_second, name).drop("_sum", "_peak")


def rate_cap_step(
    df: DataFrame, order: Sequence[str], amount: Column, per_second: float, name: str = "delay",
    spent: float = 0.0, peak: float | None = None,
) -> DataFrame:
    """As `rate_cap_lag` after rows of a summed amount of `spent` and a largest A_k - S_{k-1} of `peak`; both
    figures up to each row are kept as `_sum` and `_peak`."""
    ts = order[0]
    seconds = F.unix_micros(F.col(ts)) / F.lit(1e6)
    sliced = slice_ordered(df.withColumn("_amount", amount.cast("double")), [], order)
    before = (F.col("_sum") - F.col("_amount")) / F.lit(float(per_second))
    served = running(sliced, [], order, {"_sum": ("sum", F.col("_amount"))}).withColumn("_sum", F.col("_sum") + F.lit(float(spent)))
    served = served.withColumns({"_s": F.col("_sum") / F.lit(float(per_second)), "_gap": seconds - before})
    peaks = running(served, [], order, {"_peak": ("max", F.col("_gap"))})
    if peak is not None:
        peaks = peaks.withColumn("_peak", F.greatest("_peak", F.lit(float(peak))))
    delay = F.greatest(F.lit(0.0), F.col("_s") + F.col("_peak") - 1 - seconds)
    return peaks.withColumn(name, delay).drop("_s", "_gap", "_amount", "_slice")


def rate_cap_report(
    df: DataFrame, order: Sequence[str], size: str, lines_per_second: float, bytes_per_second: float
) -> DataFrame:
    """Per UTC day: how far delivery would fall behind a line cap and a byte cap."""
    ts = order[0]
    narrow = df.select(*order, size)
    lagged = rate_cap_lag(narrow, order, F.lit(1), lines_per_second, "line_delay")
    lagged = rate_cap_lag(lagged, order, F.col(size), bytes_per_second, "byte_delay")
    return lagged.groupBy(F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(size).alias("bytes"),
        F.max("line_delay").alias("max_line_delay"),
        F.max("byte_delay").alias("max_byte_delay"),
        F.count_if(F.greatest("line_delay", "byte_delay") > 0).alias("delayed"),
    )
