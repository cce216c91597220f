"""Join-shaped lookups between logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def correlate_requests(
    bodies: DataFrame, rows: DataFrame, pattern: str, log_id: str, body: str, request_id: str, ts: str
) -> DataFrame:
    """Request ids mentioned in debug-log bodies, with the file rows that carry them.

    Ids are extracted from the text and met by equality. Both sides are reduced before they meet: a
    log names an id once, and an id brings the count and time span of its rows, not the rows.
    """
    named = bodies.select(
        log_id, F.explode(F.regexp_extract_all(F.col(body), F.lit(pattern), F.lit(0))).alias("request_id")
    ).distinct()
    known = rows.groupBy(F.col(request_id).alias("request_id")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    return named.join(known, "request_id")
