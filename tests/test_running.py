"""Operators that carry state over an order, against direct loops and with hot groups."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidelog.operators import budget, packing, series, streaks
from tidelog.operators.packing import assign_batches
from tidelog.operators.running import numbered, running, slice_ordered
from tidelog.operators.series import histogram, histogram_quantile, quantiles

START = datetime(2024, 1, 1)


def skewed(n=600, seed=3):
    """A third of the rows belong to one key, and one key is null."""
    rng = random.Random(seed)
    keys = ["hot", "hot", "a", "b", None, "c"]
    return [(rng.choice(keys), i, rng.choice([None, 1.0, 2.5, 4.0]), rng.randint(0, 9)) for i in range(n)]


SCHEMA = "key string, pos int, value double, size int"


def test_running_values(spark):
    data = skewed()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    sliced = slice_ordered(df, ["key"], ["pos"], slices=7)
    hot_slices = {r[0] for r in sliced.filter("key = 'hot'").select("_slice").distinct().collect()}
    assert len(hot_slices) > 1
    out = running(
        sliced, ["key"], ["pos"],
        {
            "total": ("sum", F.col("size")), "high": ("max", F.col("value")), "low": ("min", F.col("value")),
            "seen": ("last", F.col("value")), "all": ("total", F.col("size")),
        },
    )
    want, groups = [], defaultdict(list)
    for key, pos, value, size in data:
        groups[key].append((value, size))
        values = [v for v, _ in groups[key] if v is not None]
        want.append(
            (key, pos, sum(s for _, s in groups[key]), max(values, default=None), min(values, default=None),
             values[-1] if values else None)
        )
    everything = {k: sum(s for _, s in g) for k, g in groups.items()}
    want = [(*w, everything[w[0]]) for w in want]
    got = out.select("key", "pos", "total", "high", "low", "seen", "all")
    assert rows(got) == sorted(want, key=str)


def test_running_before_the_row(spark):
    data = skewed(90)
    sliced = slice_ordered(spark.createDataFrame(data, SCHEMA), ["key"], ["pos"], slices=5)
    out = running(sliced, ["key"], ["pos"], {"prev": ("last", F.col("size"))}, include_row=False)
    last, want = {}, []
    for key, pos, _, size in data:
        want.append((key, pos, last.get(key)))
        last[key] = size
    assert rows(out.select("key", "pos", "prev")) == sorted(want, key=str)


def test_numbered_over_all_rows(spark):
    df = spark.createDataFrame(skewed(200), SCHEMA)
    got = rows(numbered(df, [], ["pos"]).select("pos", "position"))
    assert all(p == n for p, n in got) and len(got) == 200


def greedy(sizes, max_entries, max_bytes):
    out, held, used, batch = [], 0, 0, 0
    for size in sizes:
        if held and (held >= max_entries or used + size > max_bytes):
            batch, held, used = batch + 1, 0, 0
        held, used = held + 1, used + size
        out.append(batch)
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(("max_entries", "max_bytes", "block"), [(5, 60, 7), (3, 25, 3), (8, 1000, 16), (4, 10, 64)])
def test_batches_are_greedy_across_blocks(spark, monkeypatch, seed, max_entries, max_bytes, block):
    """Small blocks and short chains, so that a group spans many of both."""
    monkeypatch.setattr(packing, "_CHAIN", 4)
    rng = random.Random(seed)
    data = [("hot" if i % 3 else "cold", i, rng.choice([0, 1, 9, 10, 25, 26, 70])) for i in range(240)]
    df = spark.createDataFrame(data, "k string, i int, line_bytes int").repartition(6)
    got = {(k, i): b for k, i, b in assign_batches(df, ["k"], ["i"], max_entries, max_bytes, block_rows=block).collect()}
    for key in ("hot", "cold"):
        mine = [(i, s) for k, i, s in data if k == key]
        want = greedy([s for _, s in mine], max_entries, max_bytes)
        assert [got[key, i] for i, _ in mine] == want


def test_batches_need_an_entry_limit(spark):
    with pytest.raises(ValueError):
        assign_batches(spark.range(1), [], ["id"], max_entries=0)


def sized(spark, data):
    return spark.createDataFrame(data, "ts timestamp, id int, line_bytes int").repartition(4)


def random_day_rows(seed, n=240):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        # A third of all rows share one instant.
        at = timedelta(days=1, hours=7) if rng.random() < 0.33 else timedelta(minutes=rng.randint(0, 5 * 1440))
        out.append((START + at, i, rng.choice([0, 1, 10, 50])))
    return out


@pytest.mark.parametrize("limit", [0, 137, 500, 10**6])
def test_budget_keeps_the_prefix_of_a_day(spark, limit):
    data = random_day_rows(1)
    out = budget.apply_daily_budget(sized(spark, data), limit, ["ts", "id"])
    used, want = defaultdict(int), {}
    for ts, i, size in sorted(data):
        used[ts.date()] += size
        want[i] = used[ts.date()] > limit
    assert {r["id"]: r["over_budget"] for r in out.collect()} == want


@pytest.mark.parametrize("limit", [90, 400, 2000, 10**6])
def test_held_rows_wait_in_line(spark, limit):
    data = random_day_rows(2)
    out = budget.hold_over_budget(sized(spark, data), limit, ["ts", "id"])
    # Fluid line: a day's end of delivery is the smaller of all arrivals and yesterday's end + limit.
    arrived, queue = defaultdict(int), sorted(data)
    for ts, _, size in queue:
        arrived[ts.date()] += size
    day, total, served, ends = START.date(), 0, 0, []
    everything = sum(arrived.values())
    while served < everything or day <= date(2024, 1, 6):
        total += arrived[day]
        served = min(total, served + limit)
        ends.append((day, served))
        day += timedelta(days=1)
    want, upto = {}, 0
    for ts, i, size in queue:
        upto += size
        want[i] = next(d for d, s in ends if s >= upto and d >= ts.date())
    assert {r["id"]: r["deliver_on"] for r in out.collect()} == want


def test_budget_report_warns_at_four_fifths(spark):
    data = [(START + timedelta(hours=h), h, 10) for h in range(12)]
    day = budget.budget_report(sized(spark, data), 100, ["ts", "id"]).select(
        "used_bytes", "dropped_bytes", "dropped_rows", F.col("warned_at").cast("timestamp_ntz")
    ).first()
    assert tuple(day) == (100, 20, 2, START + timedelta(hours=7))


def test_rate_cap_is_a_token_bucket(spark):
    rng = random.Random(5)
    at, data = 0.0, []
    for i in range(150):
        at += rng.choice([0.0, 0.0, 0.1, 0.9, 3.0])
        data.append((START + timedelta(seconds=round(at, 1)), i, rng.choice([1, 2, 5])))
    rate = 5.0
    out = budget.rate_cap_lag(sized(spark, data), ["ts", "id"], F.col("line_bytes"), rate)
    got = {r["id"]: r["delay"] for r in out.collect()}
    tokens, clock, want = rate, 0.0, {}
    for ts, i, size in sorted(data):
        arrival = (ts - START).total_seconds()
        now = max(clock, arrival)
        tokens = min(rate, tokens + (now - clock) * rate)
        wait = max(0.0, (size - tokens) / rate)
        now += wait
        tokens = min(rate, tokens + wait * rate) - size
        clock, want[i] = now, now - arrival
    assert all(abs(got[i] - want[i]) < 1e-5 for i in want)


def test_failure_streaks(spark):
    data = [("t", i, f) for i, f in enumerate([1, 1, 0, 1, 1, 1, 0, 0, 1, 1, 1, 1])] + [("u", 0, 1)]
    df = spark.createDataFrame(data, "topic string, pos int, failed int")
    got = rows(streaks.failure_streaks(df, ["topic"], ["pos"], F.col("failed") == 1, 3))
    assert got == [("t", 3, 3, 5), ("t", 4, 8, 11)]


def test_ingest_clock_never_repeats(spark):
    df = spark.createDataFrame([(f, r) for f in range(3) for r in range(20)], "file int, row int")
    got = streaks.ingest_clock(df, ["file", "row"], "2024-01-01").orderBy("file", "row")
    micros = [r[0] for r in got.select(F.unix_micros("ingest_ts")).collect()]
    assert micros == list(range(micros[0], micros[0] + 60))


def test_quantiles_of_a_hot_group(spark):
    rng = random.Random(9)
    data = [(rng.choice(["hot", "hot", "a", None]), float(rng.randint(0, 40))) for _ in range(400)] + [("one", 7.0)]
    df = spark.createDataFrame([*data, ("a", None)], "k string, v double")
    qs = [0.0, 0.33, 0.5, 0.95, 1.0]
    got = {(r["k"], r["q"]): r["value"] for r in quantiles(df, F.col("v"), qs, ["k"]).collect()}
    for key in ("hot", "a", None, "one"):
        values = sorted(v for k, v in data if k == key)
        for q in qs:
            rank = q * (len(values) - 1)
            lo, hi = values[int(rank)], values[min(int(rank) + 1, len(values) - 1)]
            assert got[key, q] == pytest.approx(lo + (hi - lo) * (rank - int(rank)))


def test_histogram_quantile(spark):
    df = spark.createDataFrame([(float(v),) for v in [0.5, 2, 3, 4, 10, 100000]], "lag double")
    hist = histogram(df, F.col("lag"), bounds=(1, 5, 15, 60))
    assert [tuple(r) for r in hist.collect()] == [(1.0, 1), (5.0, 4), (15.0, 5), (60.0, 5), (float("inf"), 6)]
    assert histogram_quantile(hist, 0.5).first()[0] == pytest.approx(1 + 4 * (3 - 1) / 3)
    assert histogram_quantile(hist, 0.95).first()[0] == 60.0


def test_an_estimated_number_of_groups_is_close(spark):
    df = spark.range(20_000).select((F.col("id") % 5_000).alias("g"))
    exact = series.group_count(df, "g").first()[0]
    estimate = series.group_count(df, "g", relative_error=0.01).first()[0]
    assert exact == 5_000 and abs(estimate - exact) < 0.04 * exact


def test_slices_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr("tidelog.operators.running.SLICE_ROWS", 50)
    sliced = slice_ordered(spark.range(1000).withColumn("g", F.lit(1)), ["g"], ["id"])
    assert sliced.select("_slice").distinct().count() > 12
    counted = running(sliced, ["g"], ["id"], {"n": ("sum", F.lit(1).cast("bigint"))})
    assert counted.filter("n <> id + 1").count() == 0
