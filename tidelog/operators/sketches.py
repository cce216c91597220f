"""Sketches stored per step and merged for any range of steps and any coarser groups.

One pass over the rows leaves, for every step and group, the row count, a sketch of the distinct values of one column
and a sketch of the quantiles of another, each of bounded size. Days, weeks and totals are merged from these rows; the
rows themselves are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.times import instant_for
from tidelog.operators.series import step_of

# Accuracy parameters of the sketches, and the relative errors that they stay within (99 % of the time): about
# 1.04 / sqrt(2 ** LG_DISTINCT) times three, and the rank error of a quantile sketch of size QUANTILE_K.
LG_DISTINCT = 12
DISTINCT_ERROR = 0.05
QUANTILE_K = 400
RANK_ERROR = 0.01


def step_sketches(
    df: DataFrame, step: str, by: Sequence[str], *, distinct: Column | None = None, value: Column | None = None, ts: str = "ts"
) -> DataFrame:
    """`step_start`, `by`, `n`, and the sketches `distinct_sketch` and `value_sketch` of every step and group."""
    aggregates = [F.count(F.lit(1)).alias("n")]
    if distinct is not None:
        aggregates.append(F.hll_sketch_agg(distinct, LG_DISTINCT).alias("distinct_sketch"))
    if value is not None:
        aggregates.append(F.kll_sketch_agg_double(value.cast("double"), QUANTILE_K).alias("value_sketch"))
    return df.groupBy(step_of(F.col(ts), step).alias("step_start"), *by).agg(*aggregates)


def merged_sketches(stored: DataFrame, by: Sequence[str | Column] = (), since: object = None, until: object = None) -> DataFrame:
    """One row a group, of the steps that begin in `[since, until)`; `by` are columns of the table or made of them."""
    if since is not None:
        stored = stored.filter(F.col("step_start") >= instant_for(stored, "step_start", since))
    if until is not None:
        stored = stored.filter(F.col("step_start") < instant_for(stored, "step_start", until))
    aggregates = [F.sum("n").alias("n")]
    if "distinct_sketch" in stored.columns:
        aggregates.append(F.hll_union_agg("distinct_sketch").alias("distinct_sketch"))
    if "value_sketch" in stored.columns:
        aggregates.append(F.kll_merge_agg_double("value_sketch", QUANTILE_K).alias("value_sketch"))
    return stored.groupBy(*by).agg(*aggregates)


def distinct_of(sketch: str = "distinct_sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile_of(q: float, sketch: str = "value_sketch") -> Column:
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(float(q)))
