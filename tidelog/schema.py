"""Fixed names: labels, time fields, bounds and the columns of the progress ledger."""

from __future__ import annotations

PROGRESS_SCHEMA = "key string, value string, seq bigint, deleted boolean"

# The closed label set, and the two keys only a row itself may set.
ALLOWED_LABELS = (
    "job", "service_name", "source", "event_type", "sf_org_id", "environment", "org",
)
RESERVED_LABELS = ("source", "event_type")

# Time fields tried in order, per source.
TIME_FIELDS = {
    "eventlogfile": ("TIMESTAMP_DERIVED", "TIMESTAMP"),
    "eventlog_objects": ("EventDate", "CreatedDate"),
    "pubsub": ("EventDate", "CreatedDate", "commitTimestamp"),
    "apexlog": ("StartTime",),
}

# Where a topic event may carry its time, in the order they are tried.
TOPIC_TIMES = ("$.EventDate", "$.CreatedDate", "$.ChangeEventHeader.commitTimestamp")

# Upper bounds in seconds of the ingest-lag histogram.
LAG_BOUNDS = (1, 5, 15, 60, 300, 900, 1800, 3600, 7200, 14400, 28800, 86400)

# Which source wins when two could feed one category.
SOURCE_PRIORITY = ("pubsub", "eventlog_objects", "eventlogfile")
