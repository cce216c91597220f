"""Reading fields of a payload and writing it as a canonical line."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.labels import sorted_map


def map_field(payload: str | Column = "payload") -> Callable[[str], Column]:
    """Reader for a MAP payload; a missing key is null."""
    col = F.col(payload) if isinstance(payload, str) else payload
    return lambda name: col.getItem(name)


def json_field(line: str | Column = "line") -> Callable[[str], Column]:
    """Reader for a JSON line: only the named fields are extracted."""
    col = F.col(line) if isinstance(line, str) else line
    return lambda name: F.get_json_object(col, f"$['{name}']")


def field_reader(df: DataFrame) -> Callable[[str], Column]:
    """Read from the decoded payload while it is still there, else from the JSON line."""
    return map_field() if "payload" in df.columns else json_field()


def canonical_line(payload: Column) -> Column:
    """A MAP payload as compact JSON with ascending keys."""
    return F.to_json(sorted_map(payload), {"ignoreNullFields": "false"})


def field_line(fields: Mapping[str, Column]) -> Column:
    """Text columns as the line that `canonical_line` gives a map of those that are not null."""
    ascending = [fields[name].alias(name) for name in sorted(fields)]
    return F.to_json(F.struct(*ascending), {"ignoreNullFields": "true"})


def canonical_json(text: Column) -> Column:
    """JSON text as compact JSON with ascending keys at every level; null when it does not parse."""
    return F.to_json(F.try_parse_json(text))
