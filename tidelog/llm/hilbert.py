"""Shards along a Hilbert curve over metadata.

Each row's metadata are quantised to `BITS` bits a dimension and the row is placed at the index of its cell on
the Hilbert curve. Rows are numbered along the curve and the numbers are cut into shards whose row counts
differ by at most one. As neighbours on the curve are neighbours in every dimension, a shard spans a small
range of each, and a reader that knows the ranges (`shard_ranges`) skips the files it does not need.

Numbering is exact without sorting all rows in one place: rows are counted by cell, then by part of a cell.
A cell is split by a hash of the row into parts of bounded size, so one cell, or one id, that holds a third
of all rows is many tasks' work. Cells are at most 2**(3 * BITS), a bound that does not depend on the rows.

Defined results: null metadata count as empty text and size 0; a null text has 0 bytes and checksum 0; null
ids come first within their part; repeated rows take a place each. An empty table gives no rows. A key column
with the name of an output column is not looked at; only doc_id, text, lang and source are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.frames import written
from tidelog.session import shuffle_width

BITS = 5
SHARDS = 40
# A part of a cell has about this many rows, or this share of all rows if that is less.
PART_ROWS = 100_000
PART_SHARE = 0.001
# Columns of its own beside those of the rows.
ROW, SHARD, SLOT = "hilbert_row", "hilbert_shard", "hilbert_slot"


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of every row of cell coordinates (rows, dimensions).

    The coordinates are turned to the transposed index by undoing the curve's rotations from the coarsest bit
    on, then their Gray code is resolved and the bits of all dimensions are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for bit in (1 << b for b in range(bits - 1, 0, -1)):
        low = bit - 1
        for d in range(dims):
            flip = (x[d] & bit) > 0
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[d] = np.where(flip, x[d] if d else x[0], x[d] ^ swap)
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for bit in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where((x[-1] & bit) > 0, bit - 1, 0)
    x ^= turn
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            index = index << 1 | (x[d] >> b & 1)
    return index


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the curve index of the last three columns."""
    for batch in batches:
        cells = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (-3, -2, -1)])
        index = hilbert_index(cells, BITS) if len(batch) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(index)], names=[*batch.schema.names, "cell"])


def quantised(docs: DataFrame, row: str | None = None) -> DataFrame:
    """row (its number, or what column `row` has), doc_id, size, text_crc32, the cell coordinates by_source, by_lang,
    by_size and the cell of every row."""
    most = (1 << BITS) - 1
    bucket = lambda name: F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), F.lit(most + 1))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.octet_length(text) + 16
    rows = docs.select(
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        size.cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        bucket("source").cast("long").alias("by_source"),
        bucket("lang").cast("long").alias("by_lang"),
        # Half octaves of the size.
        F.least(F.floor(2 * F.log2(size / 16)), F.lit(most)).cast("long").alias("by_size"),
    )
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_placed, f"{fields}, cell long")


def shards(docs: DataFrame, count: int = SHARDS, row: str | None = None) -> DataFrame:
    """Every row of `docs` with size, checksum, cell, shard and slot (its place in the shard), and `row` as in `quantised`."""
    rows = written(quantised(docs, row))
    cells = rows.groupBy("cell").agg(F.count("*").alias("rows"))
    # At most 2**(3 * BITS) rows meet in this window.
    along = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("rows").over(Window.partitionBy())
    part_rows = F.least(F.lit(PART_ROWS), F.ceil(total * PART_SHARE))
    cells = written(
        cells.select(
            "cell",
            F.ceil(F.col("rows") / part_rows).alias("parts"),
            (F.sum("rows").over(along) - F.col("rows")).alias("before_cell"),
            total.alias("total"),
        )
    )
    # At most 2**(3 * BITS) rows of a few numbers.
    placed = rows.join(F.broadcast(cells), "cell").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    counts = placed.groupBy("cell", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = written(counts.select("cell", "part", (F.sum("rows").over(before) - F.col("rows")).alias("before_part")))
    order = Window.partitionBy("cell", "part").orderBy("doc_id", "text_crc32", "size", "row")
    number = placed.join(counts, ["cell", "part"]).withColumn(
        "place", F.col("before_cell") + F.col("before_part") + F.row_number().over(order) - 1
    )
    shard = F.floor(F.col("place") * count / F.col("total")).cast("int")
    first = F.ceil(F.col("shard") * F.col("total") / count)
    return number.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - first).cast("long").alias("slot"),
        "cell", "by_source", "by_lang", "by_size", "row",
    )


def shard_ranges(sharded: DataFrame) -> DataFrame:
    """Rows, bytes and the range of each dimension for every shard: what a reader prunes files by."""
    ends = [f(c).alias(f"{c}_{n}") for c in ("by_source", "by_lang", "by_size") for f, n in ((F.min, "low"), (F.max, "high"))]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *ends)


def write_shards(docs: DataFrame, folder: str, count: int = SHARDS) -> DataFrame:
    """Write `docs` in one folder a shard (`hilbert_shard=n`), in files along the curve; returns the ranges of the written shards.

    Every row goes to its own place, whatever its id, and all columns of `docs` are kept. A shard of many rows is
    written by several tasks, each a stretch of the curve.
    """
    named = written(docs.withColumn(ROW, F.monotonically_increasing_id()))
    placed = written(shards(named, count, ROW))
    home = placed.select(F.col("row").alias(ROW), F.col("shard").alias(SHARD), F.col("slot").alias(SLOT))
    along = named.join(home, ROW).repartitionByRange(max(count, shuffle_width(docs.sparkSession)), SHARD, SLOT)
    along.sortWithinPartitions(SHARD, SLOT).drop(ROW, SLOT).write.partitionBy(SHARD).parquet(folder)
    return shard_ranges(placed)
