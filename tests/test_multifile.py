"""Tables that are folders of part files give what single files give."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tidelog.operators.series import trailing_counts
from tidelog.operators.shape import shape_topic_events
from tidelog.registry import queries
from tidelog.sinks.payloads import batched, push_payloads
from tidelog.sources.csv_files import read_event_log_csv
from tidelog.sources.streams import stream_events

SF_DIR = os.environ.get("TIDELOG_SF_DIR", "/root/testdata/sf0.001")
# Their state steps once a micro-batch, so it depends on how the table is cut.
PER_BATCH = {"stream_failure_streaks"}
STREAMS = sorted(n for n in queries() if n.startswith("stream_") and n not in PER_BATCH)


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The tables, with the events in three files in the order of time."""
    folder = tmp_path_factory.mktemp("parts")
    for name in os.listdir(SF_DIR):
        if name != "events.parquet":
            os.symlink(f"{SF_DIR}/{name}", folder / name)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    third = events.count() // 3 + 1
    for n in range(3):
        part = events.filter(F.floor(F.col("event_id") / third) == n).coalesce(1)
        part.write.mode("append").parquet(str(folder / "events.parquet"))
    return str(folder)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")
@pytest.mark.parametrize("name", STREAMS)
def test_streams_over_several_files(spark, parts, name):
    whole, cut = (sorted(map(str, queries()[name](spark, d).collect())) for d in (SF_DIR, parts))
    assert whole and cut == whole


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")
def test_streaks_step_with_every_file(spark, parts):
    """The newest state counts: a topic that failed in every file has a streak of three."""
    got = {r.topic: r.streak for r in queries()["stream_failure_streaks"](spark, parts).collect()}
    assert set(got.values()) <= {0, 1, 2, 3} and max(got.values()) > 1


def test_pushed_rows_are_neither_lost_nor_multiplied(spark):
    rows = [(None, 1, "a"), ("2026-01-01 00:00:00", 2, "b"), ("2026-01-01 00:00:00", 2, "b"), (None, None, None)]
    df = spark.createDataFrame(rows, "t string, event_id long, line string").select(
        F.col("t").cast("timestamp").alias("ts"), "event_id", "line",
        F.create_map(F.lit("source"), F.lit("s")).alias("labels"), F.create_map(F.lit("k"), F.lit("v")).alias("metadata"),
    )
    got = batched(df, ["ts", "event_id"], max_entries=3)
    assert sorted(got.groupBy("batch_no").count().collect()) == [(0, 3), (1, 1)]
    documents = push_payloads(got, ["ts", "event_id"]).orderBy("batch_no").collect()
    assert [d.entries for d in documents] == [3, 1] and documents[0].document.count('["') == 3


def test_a_range_is_a_multiple_of_its_tick(spark):
    df = spark.createDataFrame([("2026-01-01 00:02:30",)], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    with pytest.raises(ValueError, match="multiple"):
        trailing_counts(df, 10, 3)


def test_a_very_wide_row_does_not_fail_the_file(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("A,B\n1,2\n" + ",".join("x" * 30_000) + "\n3,4\n")
    rows = [r.payload for r in read_event_log_csv(spark, [str(tmp_path / "wide.csv")]).collect()]
    assert [r["A"] for r in rows] == ["1", "x", "3"]
    assert rows[1]["_extra"].count("x") == 29_998


def test_latest_skips_what_is_there_and_survives_a_restart(spark, tmp_path):
    source, position, out = (str(tmp_path / n) for n in ("in", "position", "out"))
    schema = "id long"

    def run():
        rows = stream_events(spark, source, schema, start="LATEST", position=position)
        writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state"))
        writer.trigger(availableNow=True).start().awaitTermination()
        return sorted(r.id for r in spark.read.schema(schema).parquet(out).collect())

    spark.range(3).coalesce(1).write.parquet(source)
    assert run() == []
    time.sleep(0.05)
    spark.range(10, 12).coalesce(1).write.mode("append").parquet(source)
    assert run() == [10, 11]
    # Files that arrive while nothing runs are read by the next run.
    spark.range(20, 21).coalesce(1).write.mode("append").parquet(source)
    assert run() == [10, 11, 20]
    with pytest.raises(ValueError, match="starting point"):
        stream_events(spark, source, schema, start="LATEST")


def test_topic_times_are_read_by_type(spark):
    bodies = [
        ('{"EventDate": 1700000000123, "A": 1}', "2023-11-14 22:13:20.123", False),
        ('{"EventDate": "1700000000123"}', "2026-01-01 00:00:00", True),
        ('{"CreatedDate": "2025-03-04T05:06:07Z"}', "2025-03-04 05:06:07", False),
        ('{"ChangeEventHeader": {"commitTimestamp": 1700000000000}}', "2023-11-14 22:13:20", False),
        ("{}", "2026-01-01 00:00:00", True),
    ]
    rows = spark.createDataFrame([(n, b) for n, (b, _, _) in enumerate(bodies)], "n long, text string").select(
        "n", F.lit("/data/AccountChangeEvent").alias("topic"), F.try_parse_json("text").alias("body"),
        F.lit(bytearray(b"\x00\x01")).alias("replay_id"),
    )
    got = shape_topic_events(rows, now="2026-01-01").orderBy("n").collect()
    assert [(str(r.ts), r.used_fallback) for r in got] == [(t if "." not in t else t + "000", u) for _, t, u in bodies]
    assert got[0].line == '{"A":1,"EventDate":1700000000123}'
    assert (got[0].ckpt_key, got[0].ckpt_value) == ("pubsub:/data/AccountChangeEvent", "AAE=")
