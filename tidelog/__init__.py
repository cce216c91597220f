"""Event-log analytics on Spark: read, redact, shape, budget and query audit events."""

__version__ = "0.1.0"
