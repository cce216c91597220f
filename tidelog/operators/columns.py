"""Columns that are computed a single time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression later filters use but do not copy.

    A filter on a projected column is pushed below the projection together with its expression, so a
    costly one (a parsed JSON field, the size of a line that is built on the fly) runs twice per
    row. The output of a generator stays where it is.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
