"""Line size, line cap, number and position codecs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker left by a cut line, and the flat cost charged per entry.
MARKER_HEAD = "…[truncated, original "
MARKER_TAIL = " bytes]"
ENTRY_OVERHEAD = 64


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed a single time, however often the body names it.

    The optimizer copies an expensive expression to every place a pushed-down filter names it; a
    lambda variable is not copied.
    """
    return F.transform(F.array(value), body).getItem(0)


def line_bytes(line: Column) -> Column:
    """UTF-8 length."""
    return F.octet_length(line).cast("bigint")


def utf8_head(line: Column, size: Column) -> Column:
    """The longest whole-character prefix of at most `size` bytes (a character has at most 4)."""
    raw = F.encode(line, "UTF-8")
    size = F.greatest(size, F.lit(0)).cast("int")
    return F.coalesce(
        *[
            F.try_validate_utf8(F.substring(raw, F.lit(1), size - back).cast("string"))
            for back in range(4)
        ],
        F.lit(""),
    )


def cap_line(line: Column, max_bytes: int) -> Column:
    """Cut a line to `max_bytes` on a character boundary, leaving a marker when it fits.

    A non-positive limit disables the cap. Capping a capped line changes nothing.
    """
    if max_bytes <= 0:
        return line

    def capped(text: Column) -> Column:
        size = F.octet_length(text)
        marker = F.concat(F.lit(MARKER_HEAD), size.cast("string"), F.lit(MARKER_TAIL))
        room = F.lit(max_bytes) - F.octet_length(marker)
        cut = F.when(room > 0, F.concat(utf8_head(text, room), marker)).otherwise(
            utf8_head(text, F.lit(max_bytes))
        )
        return F.when(size > max_bytes, cut).otherwise(text)

    return once(line, capped)


def map_text_size(col: Column) -> Column:
    """Characters in all keys and values of a map."""
    sizes = F.transform(F.map_entries(col), lambda e: F.length(e["key"]) + F.length(e["value"]))
    return F.coalesce(F.aggregate(sizes, F.lit(0), lambda a, b: a + b), F.lit(0))


def entry_cost(line: Column, labels: Column, metadata: Column, ckpt_value: Column) -> Column:
    """Approximate size of an entry held in memory."""
    return (
        line_bytes(line)
        + F.lit(ENTRY_OVERHEAD)
        + map_text_size(labels)
        + map_text_size(metadata)
        + F.coalesce(F.length(ckpt_value), F.lit(0))
    ).cast("bigint")


def safe_int(text: Column) -> Column:
    """Float-formatted text as an integer; missing and bad values are 0."""
    return F.coalesce(text.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def position_text(position: Column) -> Column:
    return F.base64(position)


def position_bytes(text: Column) -> Column:
    return F.unbase64(text)


def position_hex(position: Column) -> Column:
    return F.lower(F.hex(position))
