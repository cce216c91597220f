"""Incremental reads of stored event tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.functions.times import instant, instant_for

DEFAULT_SETTLE_SECONDS = 300


def read_since(
    rows: DataFrame,
    ts: str,
    row_id: str,
    watermark: Column | datetime | str,
    last_id: object | None = None,
    *,
    now: Column | datetime | str | None = None,
    settle_seconds: int = DEFAULT_SETTLE_SECONDS,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Rows after a compound cursor: later times, and at the same time larger ids.

    With `now`, rows younger than the settle delay stay for a later read, since their region may
    still be filling. `carried` holds ids already taken at the watermark instant. Plain filters, so
    they reach the scan.
    """
    mark = instant_for(rows, ts, watermark)
    after = F.col(ts) > mark if last_id is not None else F.col(ts) >= mark
    if last_id is not None:
        after = after | ((F.col(ts) == mark) & (F.col(row_id) > F.lit(last_id)))
    found = rows.filter(F.col(ts) >= mark).filter(after)
    if now is not None:
        edge = instant(now) - F.expr(f"INTERVAL {settle_seconds} SECOND")
        found = found.filter(F.col(ts) < instant_for(rows, ts, edge))
    if carried is not None:
        found = found.join(carried.select(row_id).distinct(), row_id, "left_anti")
    return found


def read_window_desc(
    rows: DataFrame, ts: str, row_id: str, watermark: Column | datetime | str, cap: int = 0
) -> DataFrame:
    """The oldest `cap` rows at or after the watermark, with the last instant complete.

    A cap of 0 reads all. The cut is a time, so rows of one instant are never split; they are in
    ascending order when the result is ordered by `(ts, id)`.
    """
    window = rows.filter(F.col(ts) >= instant_for(rows, ts, watermark))
    if not cap:
        return window
    # Narrow the cap's place from minute to second to instant. The whole window is counted once, by
    # minute; what follows reads one minute and one second of it, and the result's filter is a literal.
    kind = rows.schema[ts].dataType
    at = lambda micros: F.timestamp_micros(F.lit(micros)).cast(kind)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    part, left = window, cap
    for span in (60_000_000, 1_000_000, 1):
        step = F.floor(micros / span) * span
        edge = _crossing(part.groupBy(step.alias("_step")).agg(F.count(F.lit(1)).alias("_n")), left)
        if edge is None:
            # Fewer rows than the cap: every row stays.
            return window
        left -= edge["_before"]
        end = edge["_step"] + span
        part = window.filter((F.col(ts) >= at(edge["_step"])) & (F.col(ts) < at(end)))
    return window.filter(F.col(ts) < at(end))


def _crossing(counts: DataFrame, cap: int) -> Row | None:
    """The step at which the running count reaches `cap`, with the count before it.

    One row per step meets in the window: minutes of the whole range, or the steps within one.
    """
    upto = W.partitionBy(F.lit(0)).orderBy("_step").rowsBetween(W.unboundedPreceding, 0)
    ranked = counts.select("_step", "_n", F.sum("_n").over(upto).alias("_upto"))
    return (
        ranked.filter(F.col("_upto") >= cap)
        .select("_step", (F.col("_upto") - F.col("_n")).alias("_before"))
        .orderBy("_step")
        .first()
    )
