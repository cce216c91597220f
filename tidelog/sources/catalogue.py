"""Which files, types and topics to read."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.globs import matches_any
from tidelog.functions.identity import event_category
from tidelog.functions.text import safe_int
from tidelog.functions.times import instant, parse_event_time
from tidelog.operators.dedup import latest_by_id
from tidelog.operators.running import numbered

WILDCARD = "*"


def with_created(files: DataFrame) -> DataFrame:
    """Parsed `created` time and whole numbers; an unparseable date becomes null."""
    return files.withColumns(
        {
            "created": parse_event_time(F.col("CreatedDate")),
            "length": safe_int(F.col("LogFileLength")),
            "sequence": safe_int(F.col("Sequence")),
        }
    )


def select_files(
    files: DataFrame,
    event_type: str,
    interval: str,
    since: Column | datetime | str,
    limit: int | None = None,
) -> DataFrame:
    """Files of one type and interval created at or after `since`, oldest first."""
    found = with_created(
        files.filter((F.col("EventType") == event_type) & (F.col("Interval") == interval))
    ).filter(F.col("created") >= instant(since))
    ordered = found.orderBy("created", "Id")
    return ordered if limit is None else ordered.limit(limit)


def composite_order(files: DataFrame) -> DataFrame:
    """By creation time and id, unparseable dates first."""
    return files.orderBy(F.col("created").asc_nulls_first(), "Id")


def reading_places(files: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """`place`, from 0, of every file in the order of `composite_order`; `ties` tell equal ids apart.

    For catalogues too large to be sorted in one place: positions are counted over slices.
    """
    return numbered(files, [], ["created", "Id", *ties], "place")


def discover_types(files: DataFrame, interval: str) -> DataFrame:
    """Types the catalogue holds for an interval, sorted."""
    return (
        files.filter((F.col("Interval") == interval) & F.col("EventType").isNotNull())
        .select("EventType")
        .distinct()
        .orderBy("EventType")
    )


def resolve_types(
    configured: DataFrame, discovered: DataFrame, excluded: DataFrame, owned: DataFrame
) -> DataFrame:
    """Types to read and their sample rates.

    `configured(name, sample)` holds explicit types and perhaps the wildcard `*`. Discovered types
    join only with a wildcard: minus those excluded, listed, or of a category another source owns;
    they inherit the wildcard's rate.
    """
    explicit = configured.filter(F.col("name") != WILDCARD).select(
        "name", "sample", F.lit(True).alias("explicit")
    )
    wildcard = configured.filter(F.col("name") == WILDCARD).agg(F.max("sample").alias("_rate"))
    found = (
        discovered.select(F.col("EventType").alias("name"))
        .join(excluded.select("name"), "name", "left_anti")
        .join(explicit.select("name"), "name", "left_anti")
        .withColumn("category", event_category(F.lit("eventlogfile"), F.col("name")))
        .join(owned.select("category").distinct(), "category", "left_anti")
        .withColumn("_rate", wildcard.scalar())
        .filter(F.col("_rate").isNotNull())
    )
    return explicit.unionByName(
        found.select("name", F.col("_rate").alias("sample"), F.lit(False).alias("explicit"))
    )


def select_by_glob(
    names: DataFrame, include: Sequence[str], exclude: Sequence[str] = (), col: str = "name"
) -> DataFrame:
    """Distinct names that match an include glob and no exclude glob; the marker `*` is no name."""
    name = F.col(col)
    keep = matches_any(name, include) & ~matches_any(name, exclude) & (name != WILDCARD)
    return names.filter(keep).dropDuplicates([col])


def discover_stream_topics(names: DataFrame, col: str = "name") -> DataFrame:
    """Objects that are event streams, as topics, sorted."""
    topic = F.concat(F.lit("/event/"), F.col(col))
    return (
        names.filter(F.col(col).endswith("EventStream")).select(topic.alias("topic")).orderBy("topic")
    )


def latest_files(files: DataFrame) -> DataFrame:
    """The newest version of every file id; a regenerated file replaces the old one."""
    return latest_by_id(files, "Id", ["created"])


def unprocessed_files(files: DataFrame, done: DataFrame) -> DataFrame:
    """Latest versions newer than what the progress table holds for the id.

    `done(Id, created)`; a null `created` stands for any version.
    """
    seen = done.groupBy("Id").agg(
        F.max("created").alias("_seen"), F.bool_or(F.col("created").isNull()).alias("_any")
    )
    return (
        latest_files(files)
        .join(seen, "Id", "left")
        .filter(
            F.col("_any").isNull() | (~F.col("_any") & (F.col("created") > F.col("_seen")))
        )
        .drop("_seen", "_any")
    )


def settled_only(
    files: DataFrame, now: Column | datetime | str, window_minutes: float | None = None, interval: str = "Hourly"
) -> DataFrame:
    """Drop files that may still be half-written: 5 minutes for hourly files, 0 for daily ones."""
    if window_minutes is None:
        window_minutes = 5 if interval == "Hourly" else 0
    if not window_minutes:
        return files
    edge = instant(now) - F.expr(f"INTERVAL {int(window_minutes * 60)} SECOND")
    return files.filter(F.col("created").isNull() | (F.col("created") <= edge))


def split_unreadable(
    files: DataFrame, now: Column | datetime | str, max_age_hours: float, failed: str = "failed"
) -> DataFrame:
    """Add `state`: `read`, `held` or `abandoned`.

    A young unreadable file holds back itself and every later file of its type, because reading past
    it would lose it. An old one is abandoned. The hold per type is a plain minimum that the files
    are then compared with.
    """
    edge = instant(now) - F.expr(f"INTERVAL {int(max_age_hours * 3600)} SECOND")
    young = F.col(failed) & (F.col("created") >= edge)
    position = F.struct("created", "Id")
    holds = (
        files.filter(young)
        .groupBy("EventType")
        .agg(F.min(position).alias("_hold"))
    )
    state = (
        F.when(F.col("_hold").isNotNull() & (position >= F.col("_hold")), F.lit("held"))
        .when(F.col(failed), F.lit("abandoned"))
        .otherwise(F.lit("read"))
    )
    return files.join(holds, "EventType", "left").withColumn("state", state).drop("_hold")


def backfill_files(
    files: DataFrame,
    since: Column | datetime | str,
    until: Column | datetime | str,
    types: Sequence[str] | None,
    interval: str,
    done: DataFrame | None = None,
) -> DataFrame:
    """Files of `[since, until)` in creation order, minus those a previous run finished.

    An unparseable creation date counts as oldest and is read.
    """
    found = with_created(files.filter(F.col("Interval") == interval))
    if types:
        found = found.filter(F.col("EventType").isin(*types))
    found = found.filter(
        F.col("created").isNull()
        | ((F.col("created") >= instant(since)) & (F.col("created") < instant(until)))
    )
    if done is not None:
        found = found.join(done.select("Id").distinct(), "Id", "left_anti")
    return composite_order(found)
