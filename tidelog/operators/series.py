"""Range aggregations over event time: counts, rates, top-k, ratios, histograms, quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.operators.running import running, slice_ordered
from tidelog.schema import LAG_BOUNDS


def step_of(ts: Column, step: str) -> Column:
    """Start of the step `ts` falls in."""
    return F.window(ts, step)["start"]


def count_over_time(
    df: DataFrame, by: Sequence[str | Column] = (), step: str | None = None, ts: str = "ts"
) -> DataFrame:
    """Rows per group, and per step when one is given, as `n`."""
    keys = [*([step_of(F.col(ts), step).alias("step_start")] if step else []), *by]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def rate(
    df: DataFrame,
    range_seconds: float,
    by: Sequence[str | Column] = (),
    step: str | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Rows per second over the range."""
    counted = count_over_time(df, by, step, ts)
    return counted.withColumn("rate", F.col("n") / F.lit(float(range_seconds)))


def group_count(
    df: DataFrame, col: str | Column, name: str = "n_groups", relative_error: float | None = None
) -> DataFrame:
    """Number of non-empty groups; with `relative_error`, an estimate from a sketch of fixed size."""
    key = F.col(col) if isinstance(col, str) else col
    if relative_error is not None:
        return df.agg(F.approx_count_distinct(key, relative_error).alias(name))
    return df.agg(F.count_distinct(key).alias(name))


def topk(counted: DataFrame, k: int, value: str, ties: Sequence[str]) -> DataFrame:
    """The k largest rows; ties go by key."""
    return counted.orderBy(F.col(value).desc(), *ties).limit(k)


def topk_per_step(
    counted: DataFrame, k: int, value: str, ties: Sequence[str], step: str = "step_start"
) -> DataFrame:
    """The k largest rows of every step, of counts that are already aggregated."""
    order = W.partitionBy(step).orderBy(F.col(value).desc(), *ties)
    return counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def trailing_counts(
    df: DataFrame,
    range_minutes: int,
    tick_minutes: int = 1,
    by: Sequence[str] = (),
    measures: dict[str, Column] | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Sums over the range before every evaluation tick: rows with `tick - range <= ts < tick`.

    Rows are first summed per tick; only those sums, not the rows, are copied to the ticks that
    see them. Ticks whose range is empty are absent. A range that is no multiple of the tick would
    cut a tick's sum in two and is refused.
    """
    if tick_minutes < 1 or range_minutes < tick_minutes or range_minutes % tick_minutes:
        raise ValueError(f"a range of {range_minutes} min is no multiple of a tick of {tick_minutes} min")
    measures = measures or {"n": F.lit(1)}
    tick = f"{tick_minutes} minutes"
    per_tick = df.groupBy(step_of(F.col(ts), tick).alias("_at"), *by).agg(
        *[F.sum(col).alias(name) for name, col in measures.items()]
    )
    first = F.col("_at") + F.expr(f"INTERVAL {tick_minutes} MINUTE")
    last = F.col("_at") + F.expr(f"INTERVAL {range_minutes} MINUTE")
    spread = per_tick.withColumn(
        "tick", F.explode(F.sequence(first, last, F.expr(f"INTERVAL {tick_minutes} MINUTE")))
    )
    return spread.groupBy("tick", *by).agg(*[F.sum(n).alias(n) for n in measures])


def floored_ratio(part: Column, whole: Column, floor: float, scale: float = 1.0) -> Column:
    """`part / max(whole, floor) * scale`."""
    return part / F.greatest(whole.cast("double"), F.lit(floor)) * F.lit(scale)


def vector_ratio(
    left: DataFrame, right: DataFrame, on: Sequence[str], value: str = "value"
) -> DataFrame:
    """Divide two series label by label; labels found on one side only are left out."""
    a = left.select(*on, F.col(value).cast("double").alias("_num"))
    b = right.select(*on, F.col(value).cast("double").alias("_den"))
    return a.join(b, list(on)).select(*on, F.try_divide("_num", "_den").alias("ratio"))


def histogram(
    df: DataFrame, value: Column, by: Sequence[str] = (), bounds: Sequence[float] = LAG_BOUNDS
) -> DataFrame:
    """Cumulative counts at every bound and in total (`le` is infinity), one pass over the rows."""
    counted = df.groupBy(*by).agg(
        *[F.count_if(value <= b).alias(f"_b{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("_total"),
    )
    cells = [
        F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("n"))
        for i, b in enumerate(bounds)
    ]
    cells.append(F.struct(F.lit(float("inf")).alias("le"), F.col("_total").alias("n")))
    return counted.select(*by, F.explode(F.array(*cells)).alias("_cell")).select(*by, "_cell.*")


def histogram_quantile(hist: DataFrame, q: float, by: Sequence[str] = ()) -> DataFrame:
    """Quantile by linear interpolation inside the bucket that crosses `q * total`.

    A crossing in the unbounded bucket yields the largest finite bound.
    """
    group = W.partitionBy(*(by or [F.lit(0)]))
    ordered = group.orderBy("le")
    ranked = hist.withColumns(
        {
            "_total": F.max("n").over(group),
            "_low": F.coalesce(F.lag("le").over(ordered), F.lit(0.0)),
            "_before": F.coalesce(F.lag("n").over(ordered), F.lit(0)),
        }
    )
    crossing = ranked.filter((F.col("n") >= q * F.col("_total")) & (F.col("_total") > 0))
    first = crossing.groupBy(*by).agg(
        F.min_by(F.struct("le", "n", "_low", "_before", "_total"), "le").alias("c")
    )
    inside = F.col("c._low") + (F.col("c.le") - F.col("c._low")) * F.try_divide(
        q * F.col("c._total") - F.col("c._before"), F.col("c.n") - F.col("c._before")
    )
    is_top = F.col("c.le") == F.lit(float("inf"))
    return first.select(*by, F.when(is_top, F.col("c._low")).otherwise(inside).alias("quantile"))


def quantiles(
    df: DataFrame, value: Column, qs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group and `q`.

    Equal values are counted together before anything is ordered, and the running counts go over
    range slices, so one hot group is never held by one task. Null values do not count.
    """
    counts = (
        df.select(*by, value.cast("double").alias("v"))
        .filter(F.col("v").isNotNull())
        .groupBy(*by, "v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    sliced = slice_ordered(counts, by, ["v"])
    ranked = running(
        sliced, by, ["v"], {"_upto": ("sum", F.col("_n")), "_total": ("total", F.col("_n"))}
    )
    first, past = F.col("_upto") - F.col("_n"), F.col("_upto")

    def spot(q: float) -> Column:
        rank = F.lit(float(q)) * (F.col("_total") - 1)
        low, high = F.floor(rank), F.ceil(rank)
        found = F.struct(
            F.lit(float(q)).alias("q"),
            (rank - low).alias("part"),
            F.when((first <= low) & (low < past), F.col("v")).alias("low"),
            F.when((first <= high) & (high < past), F.col("v")).alias("high"),
        )
        return F.when((first <= high) & (low < past), found)

    # Of all distinct values only the one or two around each quantile survive the filter.
    hits = ranked.select(*by, F.explode(F.array(*[spot(q) for q in qs])).alias("_h"))
    low, high = F.max("_h.low"), F.max("_h.high")
    return (
        hits.filter(F.col("_h").isNotNull())
        .groupBy(*by, F.col("_h.q").alias("q"))
        .agg((low + (high - low) * F.max("_h.part")).alias("value"))
    )


def approx_quantiles(
    df: DataFrame, value: Column, qs: Sequence[float], by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """One-pass quantiles with a bounded sketch per group, for dashboards that can bear an error."""
    sketch = df.groupBy(*by).agg(
        F.percentile_approx(value, [float(q) for q in qs], accuracy).alias("_v")
    )
    pairs = F.arrays_zip(F.array(*[F.lit(float(q)) for q in qs]).alias("q"), F.col("_v").alias("value"))
    return sketch.select(*by, F.explode(pairs).alias("_p")).select(*by, "_p.*")


def average(df: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """Mean of an extracted number; text that is no number does not count."""
    return df.groupBy(*by).agg(F.avg(value.try_cast("double")).alias("average"))
