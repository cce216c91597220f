"""Event-log CSV files, each with a header of its own, in one scan.

Files are read as lines of text and split over tasks like any text. Whether a line begins inside a quoted cell
follows from the lines before it: a line takes the state it begins in (outside or inside such a cell) to the
state the next one begins in, so that the states of a split are known for either start, and the start of
each split follows from the splits before it, one row each. A line that begins and ends outside is a record;
lines of a record with line breaks are put together, and only those move. No cell, row or header has a largest
size, and nothing per file comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import broadcast_if_small, cut_lineage

OVERFLOW = "_extra"
BLANK = ("", "\r")
# One cell of a record: the quoted form with doubled quotes, or anything without a comma.
_CELL = r'(?s)(?:\A|,)("[^"]*+(?:""[^"]*+)*+"[^,]*|[^,]*)'
# What lies between commas when every quoted cell is closed; and what closes a cell that was left open.
_WHOLE = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+)'
_STAYS_OUT = rf"(?s)\A{_WHOLE}(?:,{_WHOLE})*+\z"
_COMES_OUT = rf'(?s)\A[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_WHOLE})*+\z'
_PACKED = r"[.](gz|bz2|zst|lz4|snappy|deflate)\z"
_LINES = "path string, block long, at long, value string, out_open boolean, in_open boolean, out_no long, in_no long, out_ends boolean, in_ends boolean, bytes long, file_bytes long"


def _unquoted(cell: Column) -> Column:
    inner = F.replace(F.regexp_replace(cell, r'(?s)\A"(.*)"\z', "$1"), F.lit('""'), F.lit('"'))
    return F.when(cell.startswith('"'), inner).otherwise(cell)


def _cells(record: Column) -> Column:
    text = F.regexp_replace(record, r"\r?\n?\z", "")
    return F.transform(F.regexp_extract_all(text, F.lit(_CELL), F.lit(1)), _unquoted)


class _Split:
    """Lines of one split: for a start outside (0) and inside (1) a cell, the state now and the records begun."""

    def __init__(self) -> None:
        self.at, self.state, self.begun = 0, [0, 1], [0, 0]

    def take(self, stays_out: np.ndarray, comes_out: np.ndarray, blank: np.ndarray) -> dict[str, np.ndarray]:
        n = len(stays_out)
        # A line leads out from both states, in from both, from each to the other, or changes nothing.
        fixed = stays_out == comes_out
        flips = np.concatenate(([0], np.cumsum(~stays_out & comes_out)))
        last = np.maximum.accumulate(np.concatenate(([-1], np.where(fixed, np.arange(n), -1))))
        since = flips - flips[last + 1]
        out = {"at": self.at + np.arange(n)}
        for start, name in enumerate(("out", "in")):
            led_in = np.where(last < 0, self.state[start], ~stays_out[np.maximum(last, 0)])
            state = (led_in + since) % 2 == 1
            out[f"{name}_open"], out[f"{name}_ends"] = state[:-1], ~state[1:]
            out[f"{name}_no"] = self.begun[start] + np.cumsum(~state[:-1] & ~blank)
            self.state[start], self.begun[start] = int(state[-1]), int(out[f"{name}_no"][-1])
        self.at += n
        return out


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the states of every line to (path, block, value, stays_out, comes_out, blank, bytes, file_bytes)."""
    own, name = _Split(), None
    for batch in batches:
        if not len(batch):
            continue
        path, block = batch["path"], batch["block"]
        new = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(block[1:], block[:-1]))
        cuts = [0, *(np.flatnonzero(np.asarray(new)) + 1).tolist(), len(batch)]
        found = []
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if name != (path[low].as_py(), block[low].as_py()):
                own, name = _Split(), (path[low].as_py(), block[low].as_py())
            flags = (np.asarray(batch[c][low:high]).astype(bool) for c in ("stays_out", "comes_out", "blank"))
            found.append(own.take(*flags))
        columns = {c: batch[c] for c in ("path", "block", "value", "bytes", "file_bytes")}
        columns |= {c: pa.array(np.concatenate([f[c] for f in found])) for c in found[0]}
        names = [field.split()[0] for field in _LINES.split(", ")]
        yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)


@dataclass(frozen=True)
class CsvScan:
    """The lines of some files with their states for either start of their split, and a row for every file with a line.

    `files` has path, the start of every split (block, open, before: whether it begins inside a cell, and the
    records begun before it), rows (records without the header), bytes (as read, unpacked), file_bytes (as listed)
    and compressed. Both are written out.
    """

    lines: DataFrame
    files: DataFrame

    def only(self, paths: DataFrame) -> CsvScan:
        """The files of a frame of paths."""
        return CsvScan(self.lines.join(paths, "path", "left_semi"), self.files.join(paths, "path", "left_semi"))

    def records(self) -> DataFrame:
        """`(path, no, record)` of all records that are not blank, from 1 for the header."""
        starts = self.files.select("path", F.explode("starts").alias("start")).select("path", "start.*")
        lines = self.lines.join(broadcast_if_small(starts, written=True), ["path", "block"])
        opened, no, ends = (F.when(F.col("open"), F.col(f"in_{c}")).otherwise(F.col(f"out_{c}")) for c in ("open", "no", "ends"))
        placed = lines.select("path", "block", "at", "value", (F.col("before") + no).alias("no"), (~opened & ends).alias("whole"))
        # Records with line breaks; their lines count no new record.
        parts = F.sort_array(F.collect_list(F.struct("block", "at", "value")))
        text = F.array_join(F.transform(parts, lambda p: p["value"]), "\n")
        joined = placed.filter("NOT whole").groupBy("path", "no").agg(text.alias("record"))
        whole = placed.filter(F.col("whole") & ~F.col("value").isin(*BLANK))
        return whole.select("path", "no", F.col("value").alias("record")).union(joined)

    def rows(self) -> DataFrame:
        """`(path, row, payload)`; see `read_event_log_csv`."""
        records = self.records()
        header = records.filter("no = 1").select("path", _cells(F.col("record")).alias("header"))
        # The last of several columns with one name wins.
        last = F.expr(
            "filter(transform(header, (h, i) -> named_struct('name', h, 'place', i)), "
            "c -> NOT array_contains(slice(header, c.place + 2, size(header)), c.name))"
        )
        header = header.select("path", F.size("header").alias("width"), last.alias("columns"))
        rows = records.filter("no > 1").join(broadcast_if_small(header), "path").withColumn("cells", _cells(F.col("record")))
        cells = F.transform("columns", lambda c: F.coalesce(F.get("cells", c["place"]), F.lit("")))
        payload = F.map_from_arrays(F.transform("columns", lambda c: c["name"]), cells)
        extra = F.create_map(F.lit(OVERFLOW), F.array_join(F.expr("slice(cells, width + 1, size(cells))"), ","))
        spilt = F.map_concat(F.map_filter(payload, lambda k, _: k != OVERFLOW), extra)
        return rows.select(
            "path", (F.col("no") - 2).alias("row"), F.when(F.size("cells") > F.col("width"), spilt).otherwise(payload).alias("payload")
        )


def _files(lines: DataFrame) -> DataFrame:
    """What `CsvScan.files` has, from the ends of the splits, for either start of each."""
    ends = F.max_by(F.struct("out_ends", "in_ends", "out_no", "in_no"), "at").alias("ends")
    sizes = F.sum(F.col("bytes") + 1).alias("bytes"), F.max("file_bytes").alias("file_bytes")
    splits = lines.groupBy("path", "block").agg(ends, *sizes)
    # One entry for each split of a file: 100 GB in one file are a thousand of them.
    files = splits.groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("block", "ends"))).alias("splits"), F.sum("bytes").alias("bytes"), F.max("file_bytes").alias("file_bytes")
    )
    first = "named_struct('open', false, 'before', 0L, 'starts', cast(array() as array<struct<block:bigint,open:boolean,before:bigint>>))"
    following = """(s, x) -> named_struct(
        'open', if(s.open, NOT x.ends.in_ends, NOT x.ends.out_ends),
        'before', s.before + if(s.open, x.ends.in_no, x.ends.out_no),
        'starts', array_append(s.starts, named_struct('block', x.block, 'open', s.open, 'before', s.before)))"""
    files = files.withColumn("end", F.expr(f"aggregate(splits, {first}, {following})"))
    files = files.withColumn("compressed", F.col("path").rlike(_PACKED))
    # The last line may have no end of its own.
    exact = F.when(F.col("compressed"), F.col("bytes")).otherwise(F.least("bytes", "file_bytes"))
    rows = F.greatest(F.col("end.before") - 1, F.lit(0)).alias("rows")
    return files.select("path", F.col("end.starts").alias("starts"), rows, exact.alias("bytes"), "file_bytes", "compressed")


def scan_csv(spark: SparkSession, paths: Sequence[str], names: Sequence[str] = (), skip_unreadable: bool = False) -> CsvScan:
    """Read all files of some files and folders once.

    `names` keeps files of these names only; the others are not opened. With `skip_unreadable` a file that
    vanished or cannot be read on ends where it does; its `bytes` tell.
    """
    options = {"lineSep": "\n"}
    if skip_unreadable:
        options |= {"ignoreCorruptFiles": "true", "ignoreMissingFiles": "true"}
    text = spark.read.options(**options).text(list(paths))
    if names:
        text = text.filter(F.col("_metadata.file_name").isin(*names))
    raw = text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.make_valid_utf8("value").alias("value"),
        F.octet_length("value").cast("long").alias("bytes"),
        F.col("_metadata.file_size").alias("file_bytes"),
    )
    quoted = F.contains("value", F.lit('"'))
    flagged = raw.withColumns(
        {
            "stays_out": ~quoted | F.col("value").rlike(_STAYS_OUT),
            "comes_out": quoted & F.col("value").rlike(_COMES_OUT),
            "blank": F.col("value").isin(*BLANK),
        }
    )
    lines = cut_lineage(flagged.mapInArrow(_follow, _LINES))
    return CsvScan(lines, cut_lineage(_files(lines)))


def read_event_log_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """`(path, row, payload)`: one row per record, all values text; `row` counts from 0 within a file.

    Short rows are padded with empty text; cells beyond the header are joined under `_extra`;
    undecodable bytes become replacement characters; blank lines are no rows. A quoted cell that is never
    closed takes the rest of its file.
    """
    return scan_csv(spark, paths).rows()
