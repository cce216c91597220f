"""Running aggregates over an order, for groups of any size.

A plain window puts a whole group into one task, and a single topic or day can hold a third of the
rows. Here the rows are range partitioned into slices of similar size, each slice keeps its own
running values, and the slices' totals, one row per group and slice, are carried forward.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.session import broadcast_if_small, cut_lineage, shuffle_width

SLICE = "_slice"
# Rows a slice should have at most; a task sorts them.
SLICE_ROWS = 2_000_000


def slice_ordered(
    df: DataFrame, by: Sequence[str], order: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Tag each row with its range slice. `order` should be unique inside a group.

    The number of slices follows the rows, which are counted first by a pass over the narrow columns:
    a slice is one task's work. The result is written out: two readers must see the same slice bounds,
    which Spark samples anew for every exchange.
    """
    width = slices or max(
        shuffle_width(df.sparkSession), -(-df.select(*by, *order).count() // SLICE_ROWS)
    )
    ranged = df.repartitionByRange(width, *by, *order)
    return cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id()))


def _fold(kind: str, carried: Column, local: Column) -> Column:
    if kind == "total":
        return carried
    if kind == "sum":
        return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))
    if kind == "max":
        return F.greatest(carried, local)
    if kind == "min":
        return F.least(carried, local)
    return F.coalesce(local, carried)


def _over(kind: str, value: Column, window: W) -> Column:
    if kind == "last":
        return F.last(value, ignorenulls=True).over(window)
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](value).over(window)


def _total(kind: str, value: Column, order: Sequence[str]) -> Column:
    if kind == "last":
        position = F.when(value.isNotNull(), F.struct(*[F.col(c) for c in order]))
        return F.max_by(value, position)
    return {"sum": F.sum, "total": F.sum, "max": F.max, "min": F.min}[kind](value)


def running(
    sliced: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, tuple[str, Column]],
    include_row: bool = True,
) -> DataFrame:
    """Add running values up to each row; `sliced` comes from `slice_ordered`.

    `values` maps an output name to `(kind, column)`, with kind `sum`, `max`, `min`, `last` (the
    latest non-null value) or `total` (the sum of the whole group). Without `include_row` the row's own value does not count.
    """
    keys = [*by, SLICE]
    inputs = {name: f"_in_{name}" for name in values}
    frame = sliced.select("*", *[col.alias(inputs[n]) for n, (_, col) in values.items()])

    totals = frame.groupBy(*keys).agg(
        *[_total(kind, F.col(inputs[n]), order).alias(n) for n, (kind, _) in values.items()]
    )
    earlier = (
        W.partitionBy(*(by or [F.lit(0)])).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    )
    whole = W.partitionBy(*(by or [F.lit(0)]))
    carried = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[
            (F.sum(n).over(whole) if kind == "total" else _over(kind, F.col(n), earlier)).alias(
                f"_c_{n}"
            )
            for n, (kind, _) in values.items()
        ],
    )
    upto = 0 if include_row else -1
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, upto)
    local = frame.select(
        *sliced.columns,
        *[
            (F.lit(None) if kind == "total" else _over(kind, F.col(inputs[n]), inside)).alias(
                f"_l_{n}"
            )
            for n, (kind, _) in values.items()
        ],
    )
    # One row per group and slice; joined by shuffle, a null-safe key would move the rows once more.
    carried = broadcast_if_small(carried)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))
    return local.join(carried, same, "left").select(
        *sliced.columns,
        *[
            _fold(kind, F.col(f"_c_{n}"), F.col(f"_l_{n}")).alias(n)
            for n, (kind, _) in values.items()
        ],
    )


def numbered(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "position"
) -> DataFrame:
    """Zero-based position of each row in its group."""
    sliced = slice_ordered(df, by, order)
    counted = running(sliced, by, order, {name: ("sum", F.lit(1).cast("bigint"))})
    return counted.withColumn(name, F.col(name) - 1)
