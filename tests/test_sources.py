"""Sources, cursors, sinks and streams."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidelog.functions.labels import text_map
from tidelog.operators import progress as prg
from tidelog.operators.dedup import dedup_entries, first_by_id, latest_by_id
from tidelog.operators.shape import cap_entries, shape_entries
from tidelog.plans.dashboard import in_range, with_field
from tidelog.plans.quality import backfill_warnings
from tidelog.schema import PROGRESS_SCHEMA
from tidelog.sinks.entries import deliver_batch, read_entries, stream_entries, write_entries
from tidelog.sources import catalogue as cat
from tidelog.sources.csv_files import read_event_log_csv
from tidelog.sources.debug_logs import body_files, read_debug_logs
from tidelog.sources.orgs import load_limits
from tidelog.sources.streams import quarantine_poison, stream_events
from tidelog.sources.tables import read_since, read_window_desc
from tidelog.streaming.state import stream_failure_streaks, stream_last_good

CSV = {
    "a.csv": b'place,note\r\nnorth,"two\nlines, one cell"\r\nsouth,plain\r\n',
    "b.csv": b'"A","B"\n1,2,3,4\n"x ""y"", z","\xff",,\n',
    "c.csv": b"A,B,C\n1,2\n,,\n\"\",q,\"\"\n",
    "d.csv": b"A,B,C\n",
    "e.csv": b"A,B,A\n1,2,3\n",
    "f.csv": b'A,B\n1,"2","3,""q""\nnext",\n',
}


def test_csv_files_with_their_own_headers(spark, tmp_path):
    for name, data in CSV.items():
        (tmp_path / name).write_bytes(data)
    got = sorted(
        (r["path"].rsplit("/", 1)[1], sorted(r["payload"].items()))
        for r in read_event_log_csv(spark, [str(tmp_path)]).collect()
    )
    want = sorted(
        (name, sorted(payload.items()))
        for name, payload in [
            ("a.csv", {"place": "north", "note": "two\nlines, one cell"}),
            ("a.csv", {"place": "south", "note": "plain"}),
            ("b.csv", {"A": "1", "B": "2", "_extra": "3,4"}),
            ("b.csv", {"A": 'x "y", z', "B": "�", "_extra": ","}),
            ("c.csv", {"A": "1", "B": "2", "C": ""}),
            ("c.csv", {"A": "", "B": "", "C": ""}),
            ("c.csv", {"A": "", "B": "q", "C": ""}),
            ("e.csv", {"A": "3", "B": "2"}),
            ("f.csv", {"A": "1", "B": "2", "_extra": '3,"q"\nnext,'}),
        ]
    )
    assert got == want


def catalogue(spark):
    data = [
        ("f1", "Login", "Hourly", "2024-01-01T01:00:00.000+0000", "10.0", "1"),
        ("f2", "Login", "Hourly", "2024-01-01T02:00:00.000+0000", None, None),
        ("f2", "Login", "Hourly", "2024-01-02T02:00:00.000+0000", "bad", "2"),
        ("f3", "API", "Hourly", "2024-01-01T11:58:00.000+0000", "1", "1"),
        ("f4", None, "Hourly", "broken", "1", "1"),
    ]
    return spark.createDataFrame(
        data, "Id string, EventType string, Interval string, CreatedDate string, LogFileLength string, Sequence string"
    )


def test_catalogue(spark):
    files = cat.with_created(catalogue(spark))
    picked = cat.select_files(catalogue(spark), "Login", "Hourly", "2024-01-01T02:00:00Z")
    assert [(r["Id"], r["length"], r["sequence"]) for r in picked.collect()] == [("f2", 0, 0), ("f2", 0, 2)]
    assert [r[0] for r in cat.discover_types(files, "Hourly").collect()] == ["API", "Login"]
    assert sorted(r["Id"] for r in cat.latest_files(files).collect()) == ["f1", "f2", "f3", "f4"]
    settled = cat.settled_only(files, "2024-01-01 12:00:00")
    assert sorted(r["Id"] for r in settled.collect()) == ["f1", "f2", "f4"]
    assert cat.settled_only(files, "2024-01-01 12:00:00", interval="Daily").count() == 5
    assert [r["Id"] for r in cat.composite_order(files).collect()][0] == "f4"


def test_regenerated_file_is_read_again(spark):
    files = cat.with_created(catalogue(spark)).filter("Id in ('f1', 'f2')")
    done = files.filter("CreatedDate < '2024-01-02'").select("Id", "created")
    assert [r["CreatedDate"][:10] for r in cat.unprocessed_files(files, done).collect()] == ["2024-01-02"]
    legacy = done.select("Id", F.lit(None).cast("timestamp").alias("created"))
    assert cat.unprocessed_files(files, legacy).count() == 0


def test_young_unreadable_file_holds_back_later_ones(spark):
    data = [("a", "T", 1, False), ("b", "T", 2, True), ("c", "T", 3, False), ("d", "U", 3, False), ("e", "U", 1, True)]
    files = spark.createDataFrame(data, "Id string, EventType string, h int, failed boolean").withColumn(
        "created", F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, h)")
    )
    young = {r["Id"]: r["state"] for r in cat.split_unreadable(files, "2024-01-01 04:00:00", 2.5).collect()}
    assert young == {"a": "read", "b": "held", "c": "held", "d": "read", "e": "abandoned"}


def test_compound_cursor_never_splits_ties(spark):
    base = "timestamp'2024-01-01 00:00:00'"
    df = spark.range(700).select("id", F.expr(f"{base} + make_interval(0, 0, 0, 0, 0, 0, CAST(id DIV 250 AS INT))").alias("ts"))
    first = read_since(df, "ts", "id", "2024-01-01 00:00:00", 99)
    assert first.agg(F.min("id"), F.count("*")).first() == (100, 600)
    capped = read_window_desc(df, "ts", "id", "2024-01-01 00:00:00", cap=300)
    assert capped.agg(F.max("id"), F.count("*")).first() == (499, 500)
    assert read_window_desc(df, "ts", "id", "2024-01-01", cap=10_000).count() == 700
    assert read_window_desc(df, "ts", "id", "2024-01-01", cap=700).count() == 700


def test_ledger(spark, tmp_path):
    tokens = spark.createDataFrame([("a", "1", 1), ("a", "3", 3), ("a", "2", 2), ("b", "9", 1)], "key string, value string, seq bigint")
    prg.commit_progress(tokens, str(tmp_path), 0)
    prg.commit_progress(tokens.filter("key = 'a'").withColumn("seq", F.lit(4).cast("bigint")).withColumn("value", F.lit("7")).limit(1), str(tmp_path), 1)
    ledger = spark.read.schema(PROGRESS_SCHEMA).parquet(str(tmp_path))
    assert rows(prg.show_progress(ledger)) == [("a", "7"), ("b", "9")]
    assert rows(prg.show_progress(prg.set_progress(ledger, "b", "x"), "b*")) == [("b", "x")]
    assert rows(prg.show_progress(prg.delete_progress(ledger, "a"))) == [("b", "9")]
    assert rows(prg.show_progress(prg.set_progress(prg.empty_ledger(spark), "n", "1"))) == [("n", "1")]


def test_cursor_validation(spark):
    stored = ['{"last_ts": "2024-01-01T00:00:00Z", "ids": ["x"]}', "2024-01-01T00:00:00.000+0000", "", "None", "{}", None, "3"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stored)], "i int, s string")
    got = dict(df.select("i", prg.valid_cursor(F.col("s"), "2024-02-02", "1 DAY").cast("timestamp_ntz")).collect())
    good, back = datetime(2024, 1, 1), datetime(2024, 2, 1)
    assert [got[i] for i in range(7)] == [good, good, back, back, back, back, back]


def test_versions(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 1, "d")], "id int, v int, x string")
    assert rows(latest_by_id(df, "id", ["v"])) == [(1, 3, "b"), (2, 1, "d")]
    assert rows(first_by_id(df, "id", ["v"])) == [(1, 1, "a"), (2, 1, "d")]


def test_identical_entries_collapse(spark):
    data = [({"a": "1", "b": "2"}, "x"), ({"b": "2", "a": "1"}, "x"), ({"a": "1"}, "x"), ({"a": "1", "b": "2"}, "y")]
    df = spark.createDataFrame(data, "labels map<string,string>, line string").withColumn("ts", F.expr("timestamp'2024-01-01'"))
    assert dedup_entries(df).count() == 3


def test_debug_log_bodies(spark, tmp_path):
    (tmp_path / "L1.log").write_text("line one\nline two")
    meta = spark.createDataFrame(
        [("L1", 17, "2024-01-01T00:00:00Z"), ("L2", 99_999, None), ("L3", 5, "junk")], "Id string, LogLength bigint, StartTime string"
    )
    out = read_debug_logs(meta, body_files(spark, [str(tmp_path)]), 1000, now="2024-01-01 12:00:00")
    got = {r["log_id"]: r for r in out.collect()}
    assert got["L1"]["line"] == "line one\nline two" and got["L1"]["skip_reason"] is None
    assert got["L2"]["skip_reason"] == "size" and got["L2"]["line"] == '{"Id":"L2","LogLength":"99999"}'
    assert got["L3"]["metadata"]["body_skip_reason"] == "download_error" and got["L3"]["used_fallback"]


def test_limits(spark):
    doc = '{"A": {"Max": 10, "Remaining": "3.0"}, "B": {"Max": 1}, "C": 5, "D": {"Max": "x", "Remaining": 1}, "E": null}'
    df = spark.createDataFrame([(doc,), ("not json",)], "limits string")
    assert rows(load_limits(df)) == [("A", 10, 3)]


def test_unknown_schema_fails_and_poison_does_not(spark):
    known = spark.createDataFrame([("s1",)], "schema_id string")
    df = spark.createDataFrame([('{"a": 1}', "s1"), ("{oops", "s1")], "payload string, schema_id string")
    assert sorted(r["poison"] for r in quarantine_poison(df, known).select("poison").collect()) == [False, True]
    unknown = df.withColumn("schema_id", F.lit("s2"))
    with pytest.raises(PySparkException, match="unknown schema id"):
        quarantine_poison(unknown, known).collect()


def test_redacted_time_uses_the_fallback(spark):
    df = spark.createDataFrame([({"TIMESTAMP_DERIVED": "***"},)], "payload map<string,string>").withColumns(
        {"event_type": F.lit("Login"), "created": F.expr("timestamp'2024-01-01 11:30:00'")}
    )
    row = shape_entries(df, now="2024-01-01 12:00:00", source="eventlogfile", fallback=F.col("created")).first()
    assert row["used_fallback"] and row["labels"] == {"source": "eventlogfile", "event_type": "Login"}


def entry_rows(spark, n, start=0):
    df = spark.range(start, start + n).withColumns(
        {
            "ts": F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, CAST(id AS INT))"),
            "line": F.concat(F.lit("line "), F.col("id").cast("string")),
            "event_type": F.when(F.col("id") % 2 == 0, "A").otherwise("B"),
        }
    )
    return df.withColumn("labels", text_map({"event_type": F.col("event_type"), "source": F.lit("s")}))


def test_replayed_batch_changes_nothing(spark, tmp_path):
    df = entry_rows(spark, 10).withColumn("line", F.when(F.col("id") != 3, F.col("line")))
    tokens = df.select(F.lit("k").alias("key"), F.col("id").cast("string").alias("value"), F.col("id").alias("seq"))
    for _ in range(2):
        deliver_batch(df, 4, str(tmp_path), tokens=tokens)
    assert spark.read.parquet(f"{tmp_path}/entries").count() == 9
    assert spark.read.parquet(f"{tmp_path}/rejects").select("id", "reject_reason").first() == (3, "no_line")
    ledger = spark.read.schema(PROGRESS_SCHEMA).parquet(f"{tmp_path}/progress")
    assert rows(prg.show_progress(ledger)) == [("k", "9")]


def test_stream_resumes_and_finds_new_types(spark, tmp_path):
    """A second run reads only what is new, and a folder of a new type joins by itself."""
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = "id bigint, ts timestamp, line string, labels map<string,string>, event_type string"
    entry_rows(spark, 6).write.partitionBy("event_type").parquet(source)

    def run():
        stream = stream_events(spark, source, schema)
        stream_entries(stream, out, f"{tmp_path}/checkpoint").start().awaitTermination()

    run()
    assert spark.read.parquet(f"{out}/entries").count() == 6
    entry_rows(spark, 4, 100).withColumn("event_type", F.lit("New")).write.mode("append").partitionBy("event_type").parquet(source)
    run()
    stored = spark.read.parquet(f"{out}/entries")
    assert stored.count() == 10 and stored.filter("event_type = 'New'").count() == 4


def test_fully_filtered_batch_still_advances(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    entry_rows(spark, 5).write.parquet(source)
    stream = stream_events(spark, source, entry_rows(spark, 1).schema)
    writer = stream_entries(
        stream, out, f"{tmp_path}/c",
        shape=lambda b: b.filter("id < 0"),
        progress=lambda b: b.select(F.lit("k").alias("key"), F.col("id").cast("string").alias("value"), F.col("id").alias("seq")),
    )
    writer.start().awaitTermination()
    ledger = spark.read.schema(PROGRESS_SCHEMA).parquet(f"{out}/progress")
    assert rows(prg.show_progress(ledger)) == [("k", "4")]


def write_steps(spark, folder, steps, schema, run):
    for step in steps:
        spark.createDataFrame(step, schema).coalesce(1).write.mode("append").parquet(folder)
        run()


def test_last_good_time_passes_between_batches(spark, tmp_path):
    schema = "topic string, position bigint, ts timestamp"
    t = [datetime(2024, 1, 1, h) for h in range(5)]
    steps = [
        [("a", 1, None), ("a", 2, t[1]), ("a", 3, None), ("b", 1, t[0])],
        [("a", 4, None), ("c", 1, None)],
        [("a", 5, t[4]), ("a", 6, None), ("b", 2, None), ("c", 2, None)],
    ]
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def run():
        stream = stream_events(spark, folder, schema)
        stream_last_good(stream, out, f"{tmp_path}/c").start().awaitTermination()

    write_steps(spark, folder, steps, schema, run)
    got = spark.read.parquet(f"{out}/rows").select("topic", "position", F.col("filled_ts").cast("timestamp_ntz"))
    assert rows(got) == sorted(
        [("a", 1, None), ("a", 2, t[1]), ("a", 3, t[1]), ("a", 4, t[1]), ("a", 5, t[4]), ("a", 6, t[4]),
         ("b", 1, t[0]), ("b", 2, t[0]), ("c", 1, None), ("c", 2, None)], key=str,
    )


def test_streaks_pass_between_batches(spark, tmp_path):
    schema = "topic string, failed boolean"
    steps = [
        [("a", True), ("a", True), ("b", True)],
        [("a", True), ("b", False), ("b", True)],
        [("b", True)],
        [("a", True), ("b", True)],
        [("a", True), ("b", True)],
    ]
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def run():
        stream = stream_events(spark, folder, schema)
        stream_failure_streaks(stream, out, f"{tmp_path}/c", threshold=3).start().awaitTermination()

    write_steps(spark, folder, steps, schema, run)
    found = spark.read.parquet(f"{out}/findings").select("topic", "streak", "since_batch", "batch_id")
    assert rows(found) == [("a", 3, 0, 3), ("b", 3, 2, 4)]


def test_stream_start_presets(spark, tmp_path):
    with pytest.raises(ValueError):
        stream_events(spark, str(tmp_path), "a int", start="MIDDLE")


def test_backfill_warnings(spark):
    now = datetime(2024, 3, 1)
    kinds = lambda *a: [r[0] for r in backfill_warnings(spark, *a).collect()]
    assert kinds(datetime(2024, 1, 1), now) == ["retention", "old_samples"]
    assert kinds(datetime(2024, 2, 20), now, False) == []
    assert kinds(datetime(2024, 2, 28), now) == []


def test_truncation_is_recorded(spark):
    df = spark.createDataFrame([("x" * 100,), ("short",)], "line string")
    got = rows(cap_entries(df, 50).select("truncated", "original_bytes", F.octet_length("line")))
    assert got == [(False, 5, 5), (True, 100, 50)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_on_stored_entries_prunes_and_pushes(spark, tmp_path):
    write_entries(entry_rows(spark, 96), str(tmp_path), 0)
    stored = read_entries(spark, str(tmp_path))
    found = in_range(stored, "2024-01-02 12:00:00", "2024-01-03").filter("event_type = 'A'").select("line")
    assert found.count() == 6
    plan = plan_of(found)
    partition = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "date" in partition and "event_type" in partition
    assert "GreaterThanOrEqual(ts,2024-01-02" in plan
    assert "ReadSchema: struct<ts:timestamp,line:string>" in plan


def test_cursor_reaches_the_scan(spark, tmp_path):
    entry_rows(spark, 50).write.parquet(f"{tmp_path}/t")
    rows_ = spark.read.parquet(f"{tmp_path}/t")
    plan = plan_of(read_since(rows_, "ts", "id", "2024-01-01 10:00:00", 10).select("id"))
    assert "GreaterThanOrEqual(ts," in plan and "Exchange" not in plan


def test_costly_column_is_not_copied_into_filters(spark, tmp_path):
    entry_rows(spark, 50).withColumn("line", F.lit('{"CLIENT_IP":"1.1.1.1"}')).write.parquet(f"{tmp_path}/t")
    found = with_field(spark.read.parquet(f"{tmp_path}/t"), "CLIENT_IP", "ip").select("ip")
    assert plan_of(found).count("get_json_object") == 1
    assert found.count() == 50
