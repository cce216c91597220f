"""Deterministic sampling, and the category that ties one event's channels together."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SAMPLE_BUCKETS = 10_000
CATEGORY_ALIASES = {"loginhistory": "login"}
CHANNEL_SUFFIX = "(?<=.)(EventStream|EventStore|Event)$"


def sample_bucket(key: Column) -> Column:
    """First 8 bytes of sha256(key), as an unsigned number, modulo 10,000.

    The two 32-bit halves are folded with long arithmetic: 2**32 mod 10,000 is 7,296.
    """
    digest = F.sha2(key, 256)
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(digest, 9, 8), 16, 10).cast("bigint")
    return ((high % SAMPLE_BUCKETS) * (2**32 % SAMPLE_BUCKETS) + low) % SAMPLE_BUCKETS


def keep_sampled(key: Column, rate: float | Column) -> Column:
    """True for the same keys on every run; a rate of 1 or more keeps all rows."""
    if isinstance(rate, Column):
        return (rate >= 1.0) | (sample_bucket(key) < rate * SAMPLE_BUCKETS)
    if rate >= 1.0:
        return F.lit(True)
    return sample_bucket(key) < F.lit(rate * SAMPLE_BUCKETS)


def topic_event_type(topic: Column) -> Column:
    """Last path segment of a topic."""
    return F.substring_index(F.rtrim(topic, F.lit("/")), "/", -1)


def _alias(stem: Column) -> Column:
    chain = stem
    for name, category in CATEGORY_ALIASES.items():
        chain = F.when(stem == name, F.lit(category)).otherwise(chain)
    return chain


def event_category(kind: Column, name: Column) -> Column:
    """Canonical category of a topic, stored object or file event type.

    `kind` is the source name. Topics use their last segment; topics and objects lose the channel
    suffix; file types only lose their spaces.
    """
    base = F.when(kind == "pubsub", topic_event_type(name)).otherwise(name)
    stem = F.when(kind == "eventlogfile", F.replace(F.lower(name), F.lit(" "), F.lit(""))).otherwise(
        F.lower(F.regexp_replace(base, CHANNEL_SUFFIX, ""))
    )
    return _alias(stem)
