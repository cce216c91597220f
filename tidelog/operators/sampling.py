"""Deterministic row sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.globs import first_match
from tidelog.functions.identity import keep_sampled
from tidelog.functions.payload import canonical_line
from tidelog.functions.text import position_hex


def file_sample_key(payload: Column) -> Column:
    """REQUEST_ID when there is one, else the whole row."""
    request = payload.getItem("REQUEST_ID")
    return F.coalesce(F.when(request != "", request), canonical_line(payload))


def object_sample_key(payload: Column) -> Column:
    record = payload.getItem("Id")
    return F.coalesce(F.when(record != "", record), canonical_line(payload))


def topic_sample_key(replay_id: Column) -> Column:
    return position_hex(replay_id)


def sample_rows(df: DataFrame, key: Column, rate: float | Column) -> DataFrame:
    """Keep a fixed share of the keys; no filter is built for a rate of 1."""
    if not isinstance(rate, Column) and rate >= 1.0:
        return df
    return df.filter(keep_sampled(key, rate))


def rate_by_glob(topic: Column, rates: Sequence[tuple[str, float]]) -> Column:
    """The rate of the first glob that matches the topic, else 1."""
    return first_match(topic, [(g, float(r)) for g, r in rates], 1.0)
