"""Data-quality reports and run counters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.identity import event_category
from tidelog.functions.labels import disallowed_labels, stream_key
from tidelog.functions.text import line_bytes
from tidelog.functions.times import instant, seconds_between
from tidelog.schema import SOURCE_PRIORITY

# The age of a backfill's start that draws a warning.
RETENTION_DAYS = 30
LABEL_MODE_DAYS = 7
LOW_HEADROOM = 0.2


def outcome_flags(
    dropped_by: Column,
    sampled_out: Column,
    truncated: Column,
    used_fallback: Column,
    rules: Sequence[str] = (),
) -> dict[str, Column]:
    """What may have become of a row; `rules` names the rules that are counted apart. A filtered row is not sampled, and a row that is gone is neither
    cut nor timed; beyond that each counter stands for itself, so a kept row may raise two."""
    kept = dropped_by.isNull()
    delivered = kept & ~sampled_out
    return {
        **{f"filtered:{name}": dropped_by == name for name in rules},
        "filtered": ~kept,
        "sampled_out": kept & sampled_out,
        "truncated": delivered & truncated,
        "time_fallback": delivered & used_fallback,
        "delivered": delivered,
    }


def counters(flags: dict[str, Column]) -> list[Column]:
    """One aggregate per flag, for `agg` or `observe`."""
    return [F.count_if(flag).alias(name) for name, flag in flags.items()]


def outcome_counts(rows: DataFrame, flags: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """`by`, `outcome`, `n` for every flag, in one pass over the rows."""
    counted = rows.groupBy(*by).agg(*counters(flags))
    cells = [F.struct(F.lit(name).alias("outcome"), F.col(name).alias("n")) for name in flags]
    return counted.select(*by, F.inline(F.array(*cells)))


def run_summary(rows: DataFrame, file_id: str, rejected: Column, started: Column, ended: Column) -> DataFrame:
    """Files, rows pushed (attempted minus rejected), bytes and elapsed seconds of a run."""
    return rows.agg(
        F.count_distinct(file_id).alias("files"),
        F.count_if(~rejected).alias("rows_pushed"),
        F.sum(line_bytes(F.col("line"))).alias("bytes"),
        seconds_between(F.max(ended), F.min(started)).alias("elapsed_seconds"),
    )


def categorised(names: DataFrame, source: str = "source", name: str = "name") -> DataFrame:
    return names.withColumn("category", event_category(F.col(source), F.col(name)))


def overlap_report(names: DataFrame) -> DataFrame:
    """Members of every category that more than one source feeds, one row per member.

    `names(source, name)` may repeat; repeats collapse before categories are compared.
    """
    members = categorised(names.select("source", "name").distinct())
    shared = (
        members.groupBy("category")
        .agg(F.count_distinct("source").alias("sources"))
        .filter(F.col("sources") > 1)
    )
    return members.join(shared, "category").select("category", "sources", "source", "name")


def preferred_sources(names: DataFrame) -> DataFrame:
    """`category`, `preferred`, and one row per source that should not feed it beside the preferred one.

    Live events win over stored objects, and those over files.
    """
    members = categorised(names.select("source", "name").distinct()).select("category", "source").distinct()
    rank = F.array_position(F.array(*(F.lit(x) for x in SOURCE_PRIORITY)), F.col("source"))
    ranked = members.withColumn("rank", F.when(rank > 0, rank))
    best = ranked.groupBy("category").agg(F.min_by("source", "rank").alias("preferred"))
    return ranked.join(best, "category").filter("rank IS NOT NULL AND source <> preferred").select("category", "preferred", "source")


def double_count_audit(entries: DataFrame) -> DataFrame:
    """Rows per source of every category that is present through two sources."""
    counts = categorised(
        entries.groupBy("source", F.col("event_type").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    )
    shared = (
        counts.groupBy("category")
        .agg(F.count_distinct("source").alias("sources"))
        .filter(F.col("sources") > 1)
    )
    return (
        counts.join(shared, "category")
        .groupBy("category", "source")
        .agg(F.sum("n").alias("rows"))
    )


def label_sets(entries: DataFrame) -> DataFrame:
    """Rows per exact label set; a few dozen sets stand for any number of rows."""
    return entries.groupBy(stream_key(F.col("labels")).alias("_stream")).agg(F.count(F.lit(1)).alias("_rows"))


def _labels_of(sets: DataFrame) -> DataFrame:
    return sets.withColumn("labels", F.from_json("_stream", "map<string,string>"))


def label_audit(entries: DataFrame) -> DataFrame:
    """Keys outside the allowed set, with the rows and streams that carry them."""
    bad = _labels_of(label_sets(entries)).select(
        F.explode(disallowed_labels(F.col("labels"))).alias("label"), "_rows"
    )
    return bad.groupBy("label").agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("streams"))


def stream_sizes(entries: DataFrame) -> DataFrame:
    """Entries and bytes per exact label set."""
    return entries.groupBy(stream_key(F.col("labels")).alias("stream_key")).agg(
        F.count(F.lit(1)).alias("entries"), F.sum(line_bytes(F.col("line"))).alias("bytes")
    )


def cardinality_report(entries: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct values per label, and of whole label sets under the name `(stream)`."""
    sets = _labels_of(label_sets(entries))
    own = F.transform(
        F.map_entries("labels"), lambda e: F.struct(e["key"].alias("label"), e["value"].alias("value"))
    )
    whole = F.struct(F.lit("(stream)").alias("label"), F.col("_stream").alias("value"))
    cells = sets.select(F.explode(F.concat(own, F.array(whole))).alias("_c")).select("_c.*")
    count = F.approx_count_distinct("value") if approximate else F.count_distinct("value")
    return cells.groupBy("label").agg(count.alias("distinct_values"))


def entitlement_gaps(configured: DataFrame, files: DataFrame) -> DataFrame:
    """Configured types the catalogue has no file of."""
    return configured.select("name").distinct().join(
        files.select(F.col("EventType").alias("name")).distinct(), "name", "left_anti"
    )


def limit_headroom(limits: DataFrame, on: Sequence[str] = ("name",)) -> DataFrame:
    """Remaining share per limit; a maximum of 0 counts as full headroom."""
    share = F.when(F.col("max") == 0, F.lit(1.0)).otherwise(
        F.col("remaining").cast("double") / F.col("max")
    )
    return limits.select(*on, share.alias("share")).withColumn(
        "status", F.when(F.col("share") < LOW_HEADROOM, F.lit("WARN")).otherwise(F.lit("PASS"))
    )


def watermark_lag(cursors: DataFrame, by: Sequence[str], now: Column | datetime | str) -> DataFrame:
    return cursors.select(*by, seconds_between(instant(now), F.col("watermark")).alias("lag_seconds"))


def fallback_rate(entries: DataFrame, by: Sequence[str] = ("source",)) -> DataFrame:
    return entries.groupBy(*by).agg(
        F.avg(F.col("used_fallback").cast("double")).alias("fallback_rate")
    )


def truncation_report(entries: DataFrame, by: Sequence[str] = ("source",)) -> DataFrame:
    """Cut lines and lost bytes; needs the columns `cap_entries` adds."""
    lost = F.when(F.col("truncated"), F.col("original_bytes") - line_bytes(F.col("line"))).otherwise(0)
    return entries.groupBy(*by).agg(
        F.count_if("truncated").alias("truncated"), F.sum(lost).alias("bytes_lost")
    )


def backfill_warnings(
    spark: SparkSession, since: datetime, now: datetime, label_mode: bool = True
) -> DataFrame:
    """Findings on the window of a planned backfill."""
    age = now - since
    found = []
    if age > timedelta(days=RETENTION_DAYS):
        found.append(("retention", f"starts {age.days} days ago; files are kept {RETENTION_DAYS} days"))
    if label_mode and age > timedelta(days=LABEL_MODE_DAYS):
        found.append(
            ("old_samples", f"starts {age.days} days ago; true times older than "
             f"{LABEL_MODE_DAYS} days may be refused, use ingest times")
        )
    return spark.createDataFrame(found, "finding string, detail string")
