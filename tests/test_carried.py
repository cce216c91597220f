"""What passes between micro-batches, runs and restarts: budgets, caps, counters, stored entries, positions, the ledger."""

import os
import re
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidelog.functions.labels import text_map
from tidelog.operators import progress as prg
from tidelog.operators.budget import apply_daily_budget, rate_cap_lag
from tidelog.session import shared_folder
from tidelog.sinks.entries import read_entries, stream_entries, write_entries
from tidelog.sinks.stored import new_entries, store_new
from tidelog.sources.streams import position_findings, stream_events
from tidelog.streaming.limits import stream_daily_budget, stream_rate_cap

SCHEMA = "n bigint, ts timestamp, line_bytes bigint"


def sized(spark, low, high):
    """A row every ten minutes over several days, a third of them at one instant."""
    step = (F.floor(F.col("id") / 3) * 1800).cast("int")
    at = F.expr("timestamp'2024-01-01 20:00:00'") + F.make_dt_interval(secs=step)
    return spark.range(low, high).select(F.col("id").alias("n"), at.alias("ts"), (F.col("id") % 7 * 10 + 1).alias("line_bytes"))


def runs(spark, tmp_path, cuts, start):
    """Deliver the rows in several files, with a restart of the stream after each."""
    for low, high in zip(cuts, cuts[1:], strict=False):
        sized(spark, low, high).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        start(stream_events(spark, f"{tmp_path}/in", SCHEMA)).start().awaitTermination()


def test_budgets_pass_between_batches_and_restarts(spark, tmp_path):
    """Cuts inside a day, at an instant that several rows share, and after a day without rows left over."""
    out = str(tmp_path / "out")
    runs(spark, tmp_path, [0, 20, 40, 41, 90, 200], lambda s: stream_daily_budget(s, out, f"{out}/c", 700, ["ts", "n"]))
    want = apply_daily_budget(sized(spark, 0, 200), 700, ["ts", "n"]).select("n", "over_budget")
    got = spark.read.parquet(f"{out}/rows").select("n", "over_budget")
    assert rows(got) == rows(want) and got.filter("over_budget").count() > 20
    days = spark.read.parquet(f"{out}/state/batch_id=4")
    assert days.count() == 3 and days.agg(F.sum("arrived")).first()[0] == sum(i % 7 * 10 + 1 for i in range(200))


def test_caps_pass_between_batches_and_restarts(spark, tmp_path):
    out = str(tmp_path / "out")
    runs(spark, tmp_path, [0, 30, 31, 120, 200], lambda s: stream_rate_cap(s, out, f"{out}/c", F.col("line_bytes"), 0.05, ["ts", "n"]))
    want = rate_cap_lag(sized(spark, 0, 200), ["ts", "n"], F.col("line_bytes"), 0.05).select("n", F.round("delay", 3))
    got = spark.read.parquet(f"{out}/rows").select("n", F.round("delay", 3).alias("delay"))
    assert rows(got) == rows(want) and got.filter("delay > 0").count() > 20


def entries(spark, ids, day="2024-01-01"):
    made = spark.createDataFrame([(i, f"line {i}") for i in ids], "id bigint, line string")
    ts = F.expr(f"timestamp'{day}'") + F.make_dt_interval(secs=F.col("id").cast("int"))
    labels = text_map({"source": F.lit("s"), "event_type": F.lit("A")})
    return made.select(ts.alias("ts"), F.lit("A").alias("event_type"), labels.alias("labels"), "line")


def test_counters_of_a_stream_are_one_row_a_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    counted = [F.count(F.lit(1)).alias("n"), F.count_if(F.col("line").isNull()).alias("without_line")]
    for low in (0, 10, 20):
        batch = entries(spark, range(low, low + 10)).withColumn("line", F.when(~F.col("line").isin("line 3", "line 13"), F.col("line")))
        batch.coalesce(1).write.mode("append").parquet(source)
        stream = stream_events(spark, source, batch.schema)
        stream_entries(stream, out, f"{out}/c", counted=counted).start().awaitTermination()
    assert rows(spark.read.parquet(f"{out}/outcomes")) == [(10, 0, 2), (10, 1, 0), (10, 1, 1)]
    assert spark.read.parquet(f"{out}/entries").count() == 28 and spark.read.parquet(f"{out}/rejects").count() == 2


def lines(spark, out):
    return sorted(r.line for r in spark.read.parquet(f"{out}/entries").collect())


@pytest.mark.parametrize("bits", [1 << 15, 1 << 27])
def test_a_file_replayed_under_another_batch_adds_no_entry(spark, tmp_path, bits):
    out = str(tmp_path)
    store_new(entries(spark, [1, 2, 3, 3]), out, 0, bits)
    store_new(entries(spark, [2, 3, 4]), out, 1, bits)
    store_new(entries(spark, [1, 2, 3, 4]), out, 2, bits)
    assert lines(spark, out) == ["line 1", "line 2", "line 3", "line 4"]
    # The same batch again overwrites its own rows and does not find itself.
    store_new(entries(spark, [2, 3, 4]), out, 1, bits)
    assert lines(spark, out) == ["line 1", "line 2", "line 3", "line 4"]
    # Another time or another label set is another entry.
    store_new(entries(spark, [1], "2024-01-02"), out, 3, bits)
    other = entries(spark, [1]).withColumn("labels", text_map({"source": F.lit("t"), "event_type": F.lit("A")}))
    store_new(other, out, 4, bits)
    assert lines(spark, out) == ["line 1", "line 1", "line 1", "line 2", "line 3", "line 4"]


def test_only_candidate_dates_are_read(spark, tmp_path):
    out = str(tmp_path)
    for day in range(1, 6):
        store_new(entries(spark, range(5), f"2024-01-0{day}"), out, day)
    fresh = new_entries(entries(spark, [3, 77], "2024-01-04"), out, 9)
    assert [r.line for r in fresh.collect()] == ["line 77"]
    plan = fresh._jdf.queryExecution().toString()
    scan = plan[plan.index("PartitionFilters") :]
    assert "2024-01-04" in scan or "19726" in scan
    # A batch of new dates reads no stored entry at all.
    fresh = new_entries(entries(spark, [3], "2024-02-01"), out, 10)
    assert fresh.count() == 1 and "PartitionFilters" not in fresh._jdf.queryExecution().toString()


def test_a_batch_is_compared_by_one_narrow_column_and_not_staged(spark, tmp_path):
    out, staged = str(tmp_path), shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(staged))
    # More entries a date than bits once were: what is read of the store stays the same column.
    for batch_id, low in enumerate((0, 40_000, 20_000)):
        store_new(entries(spark, range(low, low + 40_000)), out, batch_id, 1 << 15)
    fresh = new_entries(entries(spark, [79_999, 80_000]), out, 3, 1 << 15)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert re.findall("ReadSchema: (.*)", plan) == ["struct<entry_name:binary>"]
    assert [r.line for r in fresh.collect()] == ["line 80000"]
    assert read_entries(spark, f"{out}/entries").count() == 80_000
    assert set(os.listdir(staged)) <= before


def test_entries_stored_without_names_are_found(spark, tmp_path):
    out = str(tmp_path)
    write_entries(entries(spark, [1, 2]), f"{out}/entries", 0)
    store_new(entries(spark, [2, 3]), out, 1)
    store_new(entries(spark, [1, 3, 4]), out, 2)
    store_new(entries(spark, [1, 2], "2024-01-02"), out, 3)
    store_new(entries(spark, [2], "2024-01-02").union(entries(spark, [4, 5])), out, 4)
    assert lines(spark, out) == ["line 1", "line 1", "line 2", "line 2", "line 3", "line 4", "line 5"]
    assert "entry_name" not in read_entries(spark, f"{out}/entries").columns


def run_latest(spark, source, position, out, **more):
    stream = stream_events(spark, source, "id long", start="LATEST", position=position, **more)
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state")
    writer.trigger(availableNow=True).start().awaitTermination()
    return sorted(r.id for r in spark.read.schema("id long").parquet(out).collect())


def test_latest_takes_files_by_what_was_listed_not_by_their_time(spark, tmp_path):
    source, position, out = (str(tmp_path / n) for n in ("in", "position", "out"))
    spark.range(3).coalesce(1).write.parquet(source)
    assert run_latest(spark, source, position, out) == []
    spark.range(10, 12).coalesce(1).write.mode("append").parquet(source)
    for name in os.listdir(source):
        # A copy that keeps its time, or a coarse clock.
        earlier = os.stat(f"{source}/{name}").st_mtime - 3600
        os.utime(f"{source}/{name}", (earlier, earlier))
    assert run_latest(spark, source, position, out) == [10, 11]
    assert position_findings(spark, position).count() == 0


@pytest.mark.parametrize("kind, finding", [("corrupt", "cannot be read"), ("empty", "no position in it"), ("old", "older than allowed")])
def test_a_refused_position_starts_from_the_earliest_file(spark, tmp_path, kind, finding):
    source, position, out = (str(tmp_path / n) for n in ("in", "position", "out"))
    spark.range(3).coalesce(1).write.parquet(source)
    if kind == "corrupt":
        os.mkdir(position)
        (tmp_path / "position" / "part-0.parquet").write_bytes(b"not a table")
    elif kind == "empty":
        spark.createDataFrame([], "_path string, _size bigint, taken timestamp").write.parquet(position)
    else:
        old = datetime.now() - timedelta(days=9)
        spark.createDataFrame([("x", 1, old)], "_path string, _size bigint, taken timestamp").write.parquet(position)
    assert run_latest(spark, source, position, out, max_position_age="3 DAYS") == [0, 1, 2]
    assert {r.finding for r in position_findings(spark, position).collect()} == {finding}


def token(spark, *found):
    return spark.createDataFrame(list(found), "key string, value string, seq bigint")


def test_compaction_changes_no_position(spark, tmp_path):
    path = str(tmp_path / "progress")
    shown = lambda: rows(prg.show_progress(prg.read_progress(spark, path)))
    assert prg.compact_progress(spark, path) is None and shown() == []
    for batch in range(6):
        prg.commit_progress(token(spark, ("a", str(batch), batch), (f"k{batch}", "x", batch)), path, batch)
    gone = token(spark, ("k2", None, 6)).withColumn("deleted", F.lit(True))
    gone.write.parquet(f"{path}/batch_id=6")
    before = shown()
    assert prg.compact_progress(spark, path) == 6 and shown() == before and len(before) == 6
    # Deleted keys and old rows are gone; a batch that is replayed, or a second compaction, changes nothing.
    assert prg.read_progress(spark, path).count() == 6
    prg.commit_progress(token(spark, ("a", "3", 3), ("k3", "x", 3)), path, 3)
    assert prg.compact_progress(spark, path) == 6 and shown() == before
    prg.commit_progress(token(spark, ("a", "9", 9), ("k2", "back", 9)), path, 7)
    assert ("a", "9") in shown() and ("k2", "back") in shown() and len(shown()) == 7
    # A snapshot that was not finished does not count.
    os.mkdir(f"{path}-snapshots/upto=7")
    assert len(shown()) == 7 and prg.compact_progress(spark, path) == 7 and len(shown()) == 7
    plan = prg.read_progress(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "7 AS batch_id" in plan and "> 7)" in plan[plan.rindex("PartitionFilters") :]


def test_sketches_of_steps_merge_to_any_range(spark):
    from tidelog.operators import sketches

    made = spark.range(20_000).select(
        (F.expr("timestamp'2024-01-01'") + F.make_dt_interval(mins=(F.col("id") % 4320).cast("int"))).alias("ts"),
        (F.col("id") % 3).alias("kind"), (F.col("id") % 1000).alias("user"), F.col("id").cast("double").alias("value"),
    )
    stored = sketches.step_sketches(made, "1 hour", ["kind"], distinct=F.col("user"), value=F.col("value"))
    assert stored.count() == 72 * 3
    one = sketches.merged_sketches(stored, since="2024-01-01", until="2024-01-02").select("n", sketches.distinct_of().alias("d"), sketches.quantile_of(0.5).alias("q")).first()
    part = made.filter("ts < '2024-01-02'")
    assert one.n == part.count() and abs(one.d - 1000) <= 1000 * sketches.DISTINCT_ERROR
    below = part.filter(F.col("value") <= one.q).count() / one.n
    assert abs(below - 0.5) <= sketches.RANK_ERROR
    by_kind = sketches.merged_sketches(stored, ["kind"]).select("kind", "n").collect()
    assert sorted(map(tuple, by_kind)) == [(0, 6667), (1, 6667), (2, 6666)]
    assert sketches.merged_sketches(stored, ["kind"], since="2025-01-01").count() == 0


def test_too_many_keys_for_a_top_list_fail(spark, tmp_path):
    from tidelog.streaming.windows import stream_top_per_window

    rows_ = spark.range(40).select(F.expr("timestamp'2024-01-01'").alias("ts"), F.concat(F.lit("k"), F.col("id") % 20).alias("key"))
    late = spark.range(1).select(F.expr("timestamp'2024-01-03'").alias("ts"), F.lit("k").alias("key"))
    rows_.union(late).coalesce(1).write.parquet(f"{tmp_path}/in")
    last = spark.range(1).select(F.expr("timestamp'2024-01-05'").alias("ts"), F.lit("k").alias("key"))
    last.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run(name, most):
        stream = stream_events(spark, f"{tmp_path}/in", "ts timestamp, key string", max_files=1)
        top = stream_top_per_window(stream, "key", 3, "1 hour", most_keys=most)
        writer = top.writeStream.format("parquet").option("path", f"{tmp_path}/{name}").option("checkpointLocation", f"{tmp_path}/{name}-c")
        writer.trigger(availableNow=True).start().awaitTermination()
        return rows(spark.read.parquet(f"{tmp_path}/{name}").select("key", "n", "rank"))

    assert set(run("few", 20)) >= {("k0", 2, 1), ("k1", 2, 2), ("k10", 2, 3)}
    with pytest.raises(Exception, match="too many keys"):
        run("many", 19)


def test_holds_fire_once_and_at_the_same_tick_for_any_cut(spark, tmp_path):
    """Spans that begin, go on and fire in different batches; gaps, false ticks and a silent series between them."""
    import random

    from tidelog.operators.alerts import pending_alerts
    from tidelog.streaming.state import stream_holds

    rng = random.Random(4)
    ticks = [(name, n, rng.random() < 0.8) for n in range(60) for name in "abc" if rng.random() < 0.95 and not (name == "c" and 20 < n < 30)]
    schema = "series string, tick timestamp, high boolean"
    made = spark.createDataFrame(ticks, "series string, n int, high boolean").select(
        "series", (F.expr("timestamp'2024-01-01'") + F.make_dt_interval(mins=F.col("n") * 5)).alias("tick"), "high", "n"
    )
    out = str(tmp_path / "out")
    for low, high in ((0, 3), (3, 4), (4, 25), (25, 26), (26, 60)):
        made.filter(F.col("n").between(low, high - 1)).drop("n").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stream_events(spark, f"{tmp_path}/in", schema)
        stream_holds(stream, out, f"{out}/c", ["series"], F.col("high"), 15, 5).start().awaitTermination()
    want = pending_alerts(made, F.col("high"), 15, 5, ["series"]).select("series", "pending_since", "firing_at")
    got = spark.read.parquet(f"{out}/alerts").select("series", "pending_since", "firing_at")
    assert rows(got) == rows(want) and got.count() > 5
