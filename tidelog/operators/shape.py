"""Payload to entry: time, labels, metadata and line."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.identity import topic_event_type
from tidelog.functions.labels import merge_maps, promote, promote_listed, text_map
from tidelog.functions.payload import canonical_line
from tidelog.functions.severity import derive_level
from tidelog.functions.text import cap_line, line_bytes
from tidelog.functions.times import extract_event_time, iso_micros, parse_event_time, parse_variant_time
from tidelog.schema import TIME_FIELDS, TOPIC_TIMES


def promote_metadata(payload: Column, fields: Sequence[str]) -> Column:
    """Listed fields plus the derived level."""
    level = text_map({"level": derive_level(lambda f: payload.getItem(f))})
    return merge_maps(promote(payload, fields), level)


def entry_labels(
    promoted: Column, source: Column, event_type: Column, static: Mapping[str, str]
) -> Column:
    """Promoted fields give way to source and event type, and those to the static labels."""
    own = {"source": source, "event_type": event_type}
    return merge_maps(promoted, text_map({**own, **static}))


def with_type_fields(
    df: DataFrame, overrides: DataFrame, global_metadata: Sequence[str]
) -> DataFrame:
    """Attach per-type field lists from `overrides(event_type, metadata_fields, label_fields)`.

    A null metadata list inherits the global one, an empty list means none, a list replaces it.
    Labels have no global list.
    """
    text_list = "array<string>"
    inherit = F.array(*[F.lit(f) for f in global_metadata]).cast(text_list)
    joined = df.join(overrides, "event_type", "left")
    return joined.withColumns(
        {
            "metadata_fields": F.coalesce(F.col("metadata_fields").cast(text_list), inherit),
            "label_fields": F.coalesce(
                F.col("label_fields").cast(text_list), F.array().cast(text_list)
            ),
        }
    )


def promote_by_type(df: DataFrame) -> DataFrame:
    """Metadata and promoted labels after `with_type_fields`."""
    payload = F.col("payload")
    level = text_map({"level": derive_level(lambda f: payload.getItem(f))})
    return df.withColumns(
        {
            "metadata": merge_maps(promote_listed(payload, F.col("metadata_fields")), level),
            "promoted": promote_listed(payload, F.col("label_fields")),
        }
    ).drop("metadata_fields", "label_fields")


def event_time(
    payload: Column, fields: Sequence[str], fallback: Column | None, now: Column | datetime | str
) -> tuple[Column, Column]:
    return extract_event_time([parse_event_time(payload.getItem(f)) for f in fields], fallback, now)


def time_by_source(source: Column, read: Callable[[str], Column]) -> Column:
    """The first time field of a row's source that holds a time; `read(name)` gives a field's time."""
    found = F.lit(None).cast("timestamp")
    for name, fields in TIME_FIELDS.items():
        found = F.when(source == name, F.coalesce(*[read(f) for f in fields])).otherwise(found)
    return found


def shape_entries(
    df: DataFrame,
    *,
    now: Column | datetime | str,
    source: str | None = None,
    time_fields: Sequence[str] | None = None,
    metadata_fields: Sequence[str] = (),
    label_fields: Sequence[str] = (),
    static: Mapping[str, str] | None = None,
    fallback: Column | None = None,
    max_line_bytes: int = 262_144,
) -> DataFrame:
    """Entries from rows with `event_type`, a MAP `payload` and, unless given, `source`.

    Adds `used_fallback`, `truncated` and `original_bytes` for the quality reports. Columns the
    entry has no place for, such as a batch or row id, are kept.
    """
    payload = F.col("payload")
    fields = time_fields or TIME_FIELDS[source or "eventlogfile"]
    ts, used_fallback = event_time(payload, fields, fallback, now)
    origin = F.lit(source) if source else F.col("source")
    line = canonical_line(payload)
    shaped = df.withColumns(
        {
            "ts": ts,
            "used_fallback": used_fallback,
            "labels": entry_labels(
                promote(payload, label_fields), origin, F.col("event_type"), static or {}
            ),
            "metadata": promote_metadata(payload, metadata_fields),
            "line": line,
        }
    )
    return cap_entries(shaped, max_line_bytes)


def shape_topic_events(
    df: DataFrame,
    *,
    now: Column | datetime | str,
    metadata_fields: Sequence[str] = (),
    label_fields: Sequence[str] = (),
    static: Mapping[str, str] | None = None,
    fallback: Column | None = None,
    max_line_bytes: int = 262_144,
) -> DataFrame:
    """Entries from topic events with `topic`, a VARIANT `body` and a BINARY `replay_id`.

    Times are read by type: numbers are milliseconds since the epoch, text is parsed. The first of
    the event's own date, its creation date and the commit time of its change header counts; rows
    with none take `fallback`, the topic's last good time. `ckpt_key` and `ckpt_value` are the topic
    and the position a run would resume after. Rows whose body did not parse are left out; poison
    rows are set aside before.
    """
    body = F.col("body")
    times = [parse_variant_time(body, path) for path in TOPIC_TIMES]
    ts, used_fallback = extract_event_time(times, fallback, now)

    def text(names: Sequence[str]) -> Column:
        return text_map({n: F.try_variant_get(body, f"$.{n}", "string") for n in names})

    shaped = df.filter(body.isNotNull()).withColumns(
        {
            "ts": ts,
            "used_fallback": used_fallback,
            "event_type": topic_event_type(F.col("topic")),
            "labels": entry_labels(
                text(label_fields), F.lit("pubsub"), topic_event_type(F.col("topic")), static or {}
            ),
            "metadata": text(metadata_fields),
            "line": F.to_json(body),
            "ckpt_key": F.concat(F.lit("pubsub:"), F.col("topic")),
            "ckpt_value": F.base64("replay_id"),
        }
    )
    return cap_entries(shaped, max_line_bytes)


def cap_entries(df: DataFrame, max_line_bytes: int) -> DataFrame:
    """Cap the line and record what was cut."""
    size = line_bytes(F.col("line"))
    over = (size > max_line_bytes) if max_line_bytes > 0 else F.lit(False)
    return df.withColumns({"original_bytes": size, "truncated": over}).withColumn(
        "line", cap_line(F.col("line"), max_line_bytes)
    )


def backfill_marks(df: DataFrame, ingest_clock: str | None = None) -> DataFrame:
    """Mark backfilled entries.

    Label mode keeps the true time and adds the label `backfill="true"`. Ingest mode, chosen by
    naming the ingest-clock column, moves the true time to metadata `event_time` instead.
    """
    if ingest_clock is None:
        return df.withColumn("labels", merge_maps(F.col("labels"), text_map({"backfill": "true"})))
    return df.withColumn(
        "metadata", merge_maps(F.col("metadata"), text_map({"event_time": iso_micros(F.col("ts"))}))
    ).withColumn("ts", F.col(ingest_clock))


def debug_log_metadata(fields: Mapping[str, Column], promoted: Column) -> Column:
    """Every non-empty field, without replacing one that was promoted already."""
    filled = F.map_filter(text_map(fields), lambda _, v: v != "")
    return merge_maps(filled, promoted)
