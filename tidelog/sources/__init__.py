"""Readers: files, catalogues, polled tables, debug logs, organisations, streams."""
