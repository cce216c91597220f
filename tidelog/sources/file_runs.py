"""Batches of event-log files, from a catalogue to stored entries: read, judge, redact, sample, shape, write, commit.

A batch has a bounded number of files of any types and is one scan and one write. Files that vanished, are cut
off or cannot be read become findings; they fail neither the batch nor its other files. Positions are kept per
file and version, and come from the files that were read, whatever became of their rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from itertools import islice
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.identity import keep_sampled
from tidelog.functions.payload import canonical_line
from tidelog.functions.times import instant, iso_micros, parse_event_time
from tidelog.operators.progress import org_prefix, read_progress, show_progress
from tidelog.operators.rules import Rule, apply_rules, check_rules
from tidelog.operators.sampling import file_sample_key
from tidelog.operators.shape import (
    backfill_marks, cap_entries, entry_labels, event_time, promote_by_type, with_type_fields,
)
from tidelog.schema import ALLOWED_LABELS, TIME_FIELDS
from tidelog.sinks.entries import deliver_batch, read_entries, reject_reason
from tidelog.sources.csv_files import CsvScan, scan_csv
from tidelog.sources.orgs import Org, tag_org

# Files a batch has at most; their names come to the driver.
BATCH_FILES = 10_000
MODES = ("live", "label", "ingest")
ENTRY_COLUMNS = ("ts", "event_type", "labels", "metadata", "line", "position_key", "position")
_LISTED = "Id string, event_type string, created long, path string, offset long"


@dataclass(frozen=True)
class TypeFields:
    """Fields of one type; no metadata list means the plan's own."""

    metadata: Sequence[str] | None = None
    labels: Sequence[str] = ()


@dataclass(frozen=True)
class FilePlan:
    """What a run does to every row: rules, then sampling by type, then the fields of its type."""

    rules: Sequence[Rule] = ()
    salt: str = ""
    rates: Mapping[str, float] = field(default_factory=dict)
    metadata_fields: Sequence[str] = ()
    types: Mapping[str, TypeFields] = field(default_factory=dict)
    static: Mapping[str, str] = field(default_factory=dict)
    org: Org | None = None
    max_line_bytes: int = 262_144

    def __post_init__(self) -> None:
        check_rules(self.rules, self.label_fields)
        bad = sorted(name for name, rate in self.rates.items() if not 0 <= rate <= 1)
        if bad:
            raise ValueError(f"sample rates must lie between 0 and 1: {', '.join(bad)}")

    @property
    def label_fields(self) -> list[str]:
        return sorted({f for own in self.types.values() for f in own.labels})

    def prefix(self, kind: str) -> str:
        """What the keys of all positions of this plan begin with."""
        return f"{kind}:{org_prefix(self.org.name)}" if self.org else f"{kind}:"


def with_outcome(rows: DataFrame, plan: FilePlan) -> DataFrame:
    """Redacted rows with `outcome`: `kept`, `dropped` by a rule or `sampled_out`; none is removed."""
    ruled = apply_rules(rows, plan.rules, plan.salt)
    outcome = F.when(F.col("dropped_by").isNotNull(), F.lit("dropped"))
    if any(rate < 1 for rate in plan.rates.values()):
        rates = F.create_map(*(F.lit(x) for name, rate in plan.rates.items() for x in (name, float(rate))))
        rate = F.coalesce(F.try_element_at(rates, F.col("event_type")), F.lit(1.0))
        outcome = outcome.when(~keep_sampled(file_sample_key(F.col("payload")), rate), F.lit("sampled_out"))
    return ruled.withColumn("outcome", outcome.otherwise(F.lit("kept"))).drop("dropped_by")


def shape_file_rows(rows: DataFrame, plan: FilePlan, now: Column | datetime | str) -> DataFrame:
    """Entries of rows with `event_type`, `created` and `payload`; an unparseable time takes the file's."""
    spark = rows.sparkSession
    lists = [(name, None if own.metadata is None else list(own.metadata), list(own.labels)) for name, own in plan.types.items()]
    overrides = spark.createDataFrame(lists, "event_type string, metadata_fields array<string>, label_fields array<string>")
    promoted = promote_by_type(with_type_fields(rows, F.broadcast(overrides), plan.metadata_fields))
    ts, used_fallback = event_time(F.col("payload"), TIME_FIELDS["eventlogfile"], F.col("created"), now)
    labels = entry_labels(F.col("promoted"), F.lit("eventlogfile"), F.col("event_type"), plan.static)
    shaped = promoted.withColumns(
        {"ts": ts, "used_fallback": used_fallback, "labels": labels, "line": canonical_line(F.col("payload"))}
    ).drop("promoted", "payload")
    shaped = cap_entries(shaped, plan.max_line_bytes)
    return tag_org(shaped, plan.org) if plan.org else shaped


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    return read_progress(spark, f"{out}/progress")


def next_batch(ledger: DataFrame) -> int:
    """The number after the last committed batch: an unfinished batch's number is taken again."""
    return (ledger.agg(F.max("batch_id")).first()[0] or 0) + 1


def done_files(ledger: DataFrame, plan: FilePlan, kind: str, take_unprefixed: bool = False) -> DataFrame:
    """`(Id, created)` of what a run of this plan has read; a file without a date counts as oldest.

    `take_unprefixed` lets one org go on from the positions of a deployment that had no orgs.
    """
    prefixes = [plan.prefix(kind)]
    if take_unprefixed and plan.org:
        prefixes.append(f"{kind}:")
    found = show_progress(ledger, f"{kind}:*")
    out = None
    for prefix in prefixes:
        own = found.filter(F.startswith("key", F.lit(prefix)))
        if prefix == f"{kind}:":
            own = own.filter(~F.startswith("key", F.lit(f"{kind}:org=")))
        oldest = F.to_timestamp(F.lit("0001-01-01"))
        own = own.select(
            F.substring("key", len(prefix) + 1, 2**31 - 1).alias("Id"),
            F.coalesce(parse_event_time(F.col("value")), oldest).alias("created"),
        )
        out = own if out is None else out.union(own)
    return out


def file_batches(files: DataFrame, size: int = BATCH_FILES) -> Iterator[list[Row]]:
    """The files of a catalogue in the order of their creation (in microseconds), undated ones first, some at a time."""
    created = F.unix_micros("created").alias("created")
    ordered = files.select("Id", "EventType", created, "length", "Path").orderBy(F.col("created").asc_nulls_first(), "Id")
    rows = ordered.toLocalIterator()
    while batch := list(islice(rows, size)):
        yield batch


def _plain(path: str) -> str:
    """A path without escapes and with one slash after its scheme."""
    return re.sub(r"\A([A-Za-z0-9+.-]+):/+", r"\1:/", path)


def _system(spark: SparkSession, path: str):  # noqa: ANN202
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()), named


def _qualified(spark: SparkSession, folders: set[str]) -> dict[str, str]:
    """The full paths of those folders that exist."""
    out = {}
    for folder in sorted(folders):
        system, path = _system(spark, folder)
        if system.exists(path):
            out[folder] = system.makeQualified(path).toString()
    return out


@dataclass
class ReadBatch:
    """What was read of some files: their scan, what is known of every file read, and the others' errors."""

    spark: SparkSession
    scan: CsvScan | None
    listed: list[Row]
    found: dict[str, Row]
    absent: dict[str, str | None]

    def error(self, file: Row) -> str | None:
        if (got := self.found.get(file.Id)) is None:
            return self.absent.get(file.Id, "missing")
        if got.bytes < got.file_bytes and not got.compressed:
            return "unreadable"
        return "truncated" if file.length and got.bytes < file.length else None

    def rows(self, file: Row) -> int:
        return self.found[file.Id].rows if file.Id in self.found else 0


def read_batch(spark: SparkSession, listed: Sequence[Row]) -> ReadBatch:
    """Read all files of a list in one scan, and say which of them were missing, cut off or broken.

    A file is whole if every byte of its listed size was read, and no fewer than the catalogue's length, if
    that has one. Names and sizes of the batch's files come to the driver.
    """
    parted = {f.Id: f.Path.rpartition("/") for f in listed if f.Path}
    folders = _qualified(spark, {folder for folder, _, _ in parted.values()})
    paths = {i: f"{folders[folder]}/{name}" for i, (folder, _, name) in parted.items() if folder in folders}
    scan, got = None, {}
    if paths:
        names = sorted({p.rpartition("/")[2] for p in paths.values()})
        scan = scan_csv(spark, sorted(set(folders.values())), names, skip_unreadable=True)
        got = {_plain(unquote(r.path)): r for r in scan.files.drop("starts").collect()}
    found = {i: got[_plain(p)] for i, p in paths.items() if _plain(p) in got}
    absent: dict[str, str | None] = {}
    for i in paths.keys() - found.keys():
        system, path = _system(spark, paths[i])
        # A file without a byte has no lines.
        if system.exists(path) and system.getFileStatus(path).getLen() == 0:
            absent[i] = None
    return ReadBatch(spark, scan, list(listed), found, absent)


def findings(batch: ReadBatch) -> DataFrame:
    """`(Id, EventType, created, error, failed)` of every file of a batch."""
    made = [(f.Id, f.EventType, f.created, batch.error(f), batch.error(f) is not None) for f in batch.listed]
    rows = batch.spark.createDataFrame(made, "Id string, EventType string, created long, error string, failed boolean")
    return rows.withColumn("created", F.timestamp_micros("created"))


def deliver_files(
    batch: ReadBatch,
    files: Sequence[Row],
    passed: Sequence[Row],
    out: str,
    number: int,
    plan: FilePlan,
    kind: str,
    *,
    now: Column | datetime | str,
    mode: str = "live",
    started: dict[str, int] | None = None,
) -> None:
    """Store the entries of `files`, and positions for them and for the `passed` ones, as one batch.

    Files without a row get no position: they are looked at again. In mode "ingest" the clock of a type
    stands at `started[type]` microseconds after `now`, and is moved on by the rows read, kept or not.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark = batch.spark
    clock, known = started if started is not None else {}, []
    for file in sorted(files, key=lambda f: (f.created is not None, f.created, f.Id)):
        if n := batch.rows(file):
            known.append((file.Id, file.EventType, file.created, batch.found[file.Id].path, clock.get(file.EventType, 0)))
            clock[file.EventType] = clock.get(file.EventType, 0) + n
    own = {
        "created": F.timestamp_micros("created"),
        "position_key": F.concat(F.lit(plan.prefix(kind)), "Id"),
        "position": F.coalesce(iso_micros(F.timestamp_micros("created")), F.lit("")),
    }
    listed = F.broadcast(spark.createDataFrame(known, _LISTED).withColumns(own))
    read_or_passed = [(k[0], k[2]) for k in known] + [(f.Id, f.created) for f in passed]
    tokens = spark.createDataFrame(read_or_passed, "Id string, created long").withColumns(own)
    tokens = tokens.select(F.col("position_key").alias("key"), F.col("position").alias("value"), F.lit(number).cast("bigint").alias("seq"))
    if known:
        rows = batch.scan.only(listed.select("path")).rows()
    else:
        rows = spark.createDataFrame([], "path string, row bigint, payload map<string,string>")
    rows = rows.join(listed, "path")
    kept = with_outcome(rows, plan).filter("outcome = 'kept'")
    shaped = shape_file_rows(kept, plan, now)
    allowed = [*ALLOWED_LABELS, *plan.label_fields]
    if mode == "ingest":
        micros = F.unix_micros(instant(now)) + F.col("offset") + F.col("row")
        shaped = backfill_marks(shaped.withColumn("ingest_ts", F.timestamp_micros(micros)), "ingest_ts")
    elif mode == "label":
        shaped = backfill_marks(shaped)
        allowed.append("backfill")
    deliver_batch(shaped.select(*ENTRY_COLUMNS), number, out, reason=reject_reason(plan.max_line_bytes, allowed), tokens=tokens)


def current_entries(spark: SparkSession, out: str) -> DataFrame:
    """Stored entries of the newest committed version of every file.

    A regenerated file replaces its older version from the moment its position is committed; what an
    unfinished batch wrote is not seen.
    """
    now = show_progress(read_ledger(spark, out)).select(F.col("key").alias("position_key"), F.col("value").alias("position"))
    return read_entries(spark, f"{out}/entries").join(now, ["position_key", "position"], "left_semi")
