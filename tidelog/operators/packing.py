"""Split ordered entries into push batches, each limited in entries and bytes.

The split is greedy: a batch closes when it holds `max_entries` or when the next line would exceed
`max_bytes`; a line larger than that is a batch of its own. Where a batch starts depends on all rows
before it, yet a hot stream must not be walked by one task. So the rows are cut into blocks, every
block answers for each row a batch could start with "where does the first batch of the next block
start, and how many batches begin here", and those small answers are chained.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.running import numbered, running, slice_ordered
from tidelog.session import cut_lineage

# Blocks chained by one task before its answer is chained with the others.
_CHAIN = 1000
_END = -1


def _next_starts(sizes: np.ndarray, max_entries: int, max_bytes: int) -> np.ndarray:
    """For a batch starting at each row, the row the following batch starts with."""
    upto = np.cumsum(sizes)
    rows = np.arange(len(sizes))
    by_size = np.searchsorted(upto, upto - sizes + max_bytes, side="right")
    return np.minimum(rows + max_entries, np.maximum(by_size, rows + 1))


def _exits(sizes: np.ndarray, own: int, max_entries: int, max_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """For a batch starting at each own row: first start past the block, and batches begun."""
    at = _next_starts(sizes, max_entries, max_bytes)[:own]
    begun = np.ones(own, dtype=np.int64)
    while (inside := at < own).any():
        hop = at[inside]
        begun[inside] += begun[hop]
        at[inside] = at[hop]
    return at, begun


def assign_batches(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    max_entries: int = 1000,
    max_bytes: int = 4_000_000,
    size: str = "line_bytes",
    block_rows: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """`by`, `keep` (the order, unless given) and `batch_no` (from 0 in each group) for every row.

    `order` must be unique inside a group. Only these columns and the size are moved; join the
    result back on `keep` when the lines are needed. `max_bytes <= 0` leaves the entry limit alone.
    """
    keep = list(keep or order)
    if max_entries < 1:
        raise ValueError("max_entries must be at least 1")
    narrow = df.select(*dict.fromkeys([*by, *order, *keep]), F.col(size).cast("bigint").alias("_size"))
    if max_bytes <= 0:
        counted = numbered(narrow, by, order, "_pos")
        batch = F.floor(F.col("_pos") / max_entries).cast("bigint")
        return counted.select(*by, *keep, batch.alias("batch_no"))

    width = block_rows or max(65_536, 16 * max_entries)
    if width < max_entries:
        raise ValueError("a block must hold at least max_entries rows")
    sliced = slice_ordered(narrow, by, order)
    counted = running(sliced, by, order, {"_n": ("sum", F.lit(1).cast("bigint"))})
    # Read three times below, by steps that each shuffle it anew.
    rows = cut_lineage(counted.select(*by, *keep, "_size", (F.col("_n") - 1).alias("_pos")))
    # The first rows of a block also go to the block before it, where batches may reach into them.
    block = F.floor(F.col("_pos") / width).cast("bigint")
    offset = F.col("_pos") % width
    homes = F.when((offset < max_entries) & (block > 0), F.array(block - 1, block)).otherwise(
        F.array(block)
    )
    placed = rows.select(*by, "_pos", "_size", F.explode(homes).alias("_block"))

    types = {f.name: f.dataType for f in narrow.schema.fields}
    group_fields = [T.StructField(c, types[c]) for c in by]
    answer = T.StructType(
        [
            *group_fields,
            T.StructField("_block", T.LongType()),
            T.StructField("exits", T.ArrayType(T.LongType())),
            T.StructField("begun", T.ArrayType(T.LongType())),
        ]
    )
    by = list(by)

    def answer_block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        number = int(pdf["_block"].iloc[0])
        own = int((pdf["_pos"] // width == number).sum())
        sizes = pdf["_size"].to_numpy(np.int64)
        at, begun = _exits(sizes, own, max_entries, max_bytes)
        exits = np.where(at >= len(sizes), _END, at - own)
        if own < width:
            exits[:] = _END
        head = {c: [pdf[c].iloc[0]] for c in by}
        return pd.DataFrame(
            {
                **head,
                "_block": [number],
                "exits": [exits[:max_entries]],
                "begun": [begun[:max_entries]],
            }
        )

    answers = cut_lineage(placed.groupBy(*by, "_block").applyInPandas(answer_block, answer))

    def chain(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Answers of consecutive blocks as the answer of the whole run."""
        at = np.arange(max_entries)
        begun = np.zeros(max_entries, dtype=np.int64)
        for exits, counts in zip(pdf["exits"], pdf["begun"], strict=True):
            exits, counts = np.asarray(exits), np.asarray(counts)
            # Starts beyond a short last block have no row to start with.
            alive = (at != _END) & (at < len(exits))
            hop = np.where(alive, at, 0)
            begun += np.where(alive, counts[hop], 0)
            at = np.where(alive, exits[hop], _END)
        return at, begun

    def answer_run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        at, begun = chain(pdf)
        head = {c: [pdf[c].iloc[0]] for c in by}
        run = int(pdf["_block"].iloc[0]) // _CHAIN
        return pd.DataFrame({**head, "_block": [run], "exits": [at], "begun": [begun]})

    entered = T.StructType(
        [
            *group_fields,
            T.StructField("_block", T.LongType()),
            T.StructField("entry", T.LongType()),
            T.StructField("base", T.LongType()),
        ]
    )

    def walk(pdf: pd.DataFrame, entry: int, base: int) -> pd.DataFrame:
        """The start each block is entered with, and the batches begun before it."""
        pdf = pdf.sort_values("_block")
        seen = []
        for exits, begun in zip(pdf["exits"], pdf["begun"], strict=True):
            seen.append((entry, base))
            if entry != _END and entry < len(exits):
                entry, base = int(exits[entry]), base + int(begun[entry])
        out = pdf[[*by, "_block"]].copy()
        out["entry"] = [e for e, _ in seen]
        out["base"] = [b for _, b in seen]
        return out

    run_of = F.floor(F.col("_block") / _CHAIN).cast("bigint")
    runs = answers.groupBy(*by, run_of.alias("_run")).applyInPandas(answer_run, answer)
    run_entries = runs.groupBy(*by).applyInPandas(lambda pdf: walk(pdf, 0, 0), entered)

    def walk_run(blocks: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        return walk(blocks, int(start["entry"].iloc[0]), int(start["base"].iloc[0]))

    block_entries = (
        answers.withColumn("_run", run_of)
        .groupBy(*by, "_run")
        .cogroup(run_entries.withColumnRenamed("_block", "_run").groupBy(*by, "_run"))
        .applyInPandas(walk_run, entered)
    )

    numbered_rows = T.StructType(
        [
            *group_fields,
            *[T.StructField(c, types[c]) for c in keep],
            T.StructField("batch_no", T.LongType()),
        ]
    )
    def number_block(own_rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        own_rows = own_rows.sort_values("_pos")
        entry, base = int(start["entry"].iloc[0]), int(start["base"].iloc[0])
        after = _next_starts(own_rows["_size"].to_numpy(np.int64), max_entries, max_bytes)
        begins = np.zeros(len(own_rows), dtype=np.int64)
        while entry != _END and entry < len(own_rows):
            begins[entry] = 1
            entry = int(after[entry])
        out = own_rows[[*by, *keep]].copy()
        out["batch_no"] = base - 1 + np.cumsum(begins)
        return out

    return (
        rows.withColumn("_block", block)
        .groupBy(*by, "_block")
        .cogroup(block_entries.groupBy(*by, "_block"))
        .applyInPandas(number_block, numbered_rows)
    )
