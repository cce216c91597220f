"""Push documents: one JSON document per stream and batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.labels import sorted_map, stream_key
from tidelog.functions.text import line_bytes
from tidelog.functions.times import epoch_nanos
from tidelog.operators.packing import assign_batches
from tidelog.session import cut_lineage

ROW = "_row"


def batched(
    df: DataFrame, order: Sequence[str], max_entries: int = 1000, max_bytes: int = 4_000_000
) -> DataFrame:
    """Entries with their `stream_key` and the number of the batch they go into.

    Every row gets a number of its own first, so copies stay apart and rows without a time are kept
    (they come first). The numbered rows are written, because both sides of the join read them.
    """
    keyed = cut_lineage(
        df.withColumns(
            {
                "stream_key": stream_key(F.col("labels")),
                "line_bytes": F.coalesce(line_bytes(F.col("line")), F.lit(0)),
                ROW: F.monotonically_increasing_id(),
            }
        )
    )
    numbers = assign_batches(
        keyed, ["stream_key"], [*order, ROW], max_entries, max_bytes, keep=[ROW]
    )
    return keyed.join(numbers.select(ROW, "batch_no"), ROW)


def push_payloads(batches: DataFrame, order: Sequence[str]) -> DataFrame:
    """One document `{"stream": {labels}, "values": [["<ns>", line, {metadata}], ...]}` per batch.

    A document gathers the rows of one batch, which `batched` limits in entries and bytes. An entry
    without a time has an empty one; `split_rejects` sets such entries aside before.
    """
    value = F.struct(
        *[F.col(c) for c in order],
        F.col(ROW),
        F.concat(
            F.lit('["'),
            F.coalesce(epoch_nanos(F.col("ts")).cast("string"), F.lit("")),
            F.lit('",'),
            F.coalesce(F.to_json(F.col("line").cast("variant")), F.lit('""')),
            F.lit(","),
            F.coalesce(F.to_json(sorted_map(F.col("metadata"))), F.lit("{}")),
            F.lit("]"),
        ).alias("_value"),
    )
    grouped = batches.groupBy("stream_key", "batch_no").agg(
        F.sort_array(F.collect_list(value)).alias("_values"),
        F.count(F.lit(1)).alias("entries"),
        F.sum("line_bytes").alias("bytes"),
    )
    values = F.array_join(F.transform("_values", lambda v: v["_value"]), ",")
    document = F.concat(
        F.lit('{"stream":'), F.col("stream_key"), F.lit(',"values":['), values, F.lit("]}")
    )
    return grouped.select("stream_key", "batch_no", "entries", "bytes", document.alias("document"))
