"""Incremental reads, cursors and the ledger (SRC-11..14, SNK-6, STR-5, AGG-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import progress as prg
from tidelog.operators.rules import Rule, apply_rules
from tidelog.plans import quality
from tidelog.registry.base import query
from tidelog.registry.tables import E_SQL, entries, raw_events, table
from tidelog.sources.tables import read_since, read_window_desc

_MARK_SQL = "(SELECT ts FROM events WHERE event_id = 5000)"


def _mark(spark: SparkSession, sf_dir: str) -> Column:
    """Time of one row, read as a scalar subquery of the plan."""
    return raw_events(spark, sf_dir).filter("event_id = 5000").select("ts").scalar()


@query(
    "read_since",
    f"""SELECT event_id, ts FROM events WHERE ts > {_MARK_SQL} OR (ts = {_MARK_SQL} AND event_id > 4990)""",
)
def since(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    return read_since(rows, "ts", "event_id", _mark(spark, sf_dir), 4990)


@query(
    "read_since_carried",
    """SELECT event_id, ts FROM (SELECT event_id, date_trunc('hour', ts) AS ts FROM events)
      WHERE ts >= TIMESTAMP '2024-01-10 12:00:00'
      AND NOT (ts = TIMESTAMP '2024-01-10 12:00:00' AND event_id % 2 = 0)
      AND ts < TIMESTAMP '2024-01-29 00:00:00' - INTERVAL 1 HOUR""",
)
def since_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly ties at the watermark: ids taken before are skipped, and the newest hour may settle."""
    rows = raw_events(spark, sf_dir).select("event_id", F.date_trunc("hour", "ts").alias("ts"))
    carried = rows.filter((F.col("ts") == "2024-01-10 12:00:00") & (F.col("event_id") % 2 == 0))
    return read_since(
        rows, "ts", "event_id", "2024-01-10 12:00:00",
        now="2024-01-29 00:00:00", settle_seconds=3600, carried=carried,
    )


@query(
    "settle_delay",
    """SELECT count(*) AS ready, (SELECT count(*) FROM events) - count(*) AS settling FROM events
      WHERE ts < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 5 MINUTE""",
)
def settle_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_events(spark, sf_dir).select("event_id", "ts")
    ready = read_since(rows, "ts", "event_id", "1970-01-01", now="2024-01-20")
    tagged = rows.join(ready.select("event_id", F.lit(True).alias("ready")), "event_id", "left")
    return tagged.agg(F.count("ready").alias("ready"), F.count_if(F.col("ready").isNull()).alias("settling"))


@query(
    "read_window_desc",
    """WITH hours AS (SELECT event_id, date_trunc('hour', ts) AS ts FROM events),
      capped AS (SELECT ts FROM hours WHERE ts >= TIMESTAMP '2024-01-05' ORDER BY ts, event_id LIMIT 700)
      SELECT event_id, ts FROM hours WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= (SELECT max(ts) FROM capped)""",
)
def window_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oldest 700 rows; the hour that the cap falls in is read to its end."""
    rows = raw_events(spark, sf_dir).select("event_id", F.date_trunc("hour", "ts").alias("ts"))
    return read_window_desc(rows, "ts", "event_id", "2024-01-05", cap=700)


@query(
    "valid_cursor",
    """SELECT event_id, CASE event_id % 5
        WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
        ELSE TIMESTAMP '2024-02-01' - INTERVAL 1 DAY END AS watermark FROM events""",
)
def valid_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON cursor, bare time, empty, garbage, and JSON without a time."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    stored = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('{"ids": [], "last_ts": "'), iso, F.lit('"}')))
        .when(F.col("event_id") % 5 == 1, iso)
        .when(F.col("event_id") % 5 == 2, "")
        .when(F.col("event_id") % 5 == 3, "None")
        .otherwise('{"last_ts": "junk"}')
    )
    return raw_events(spark, sf_dir).select(
        "event_id", prg.valid_cursor(stored, "2024-02-01", "1 DAY").alias("watermark")
    )


@query(
    "next_cursor",
    f"""WITH {E_SQL} SELECT source, event_type, max(CASE WHEN k % 13 > 1 THEN ts END) AS watermark,
      max_by(event_id, CASE WHEN k % 13 > 1 THEN ts END) AS last_id, count(*) AS rows,
      count(*) FILTER (f_COUNTRY = 'US') AS dropped FROM e GROUP BY ALL""",
)
def next_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropped rows move the cursor; rows without a time do not."""
    rows = apply_rules(entries(spark, sf_dir), [Rule("drop_row", match={"COUNTRY": "US"})])
    timed = rows.withColumn("ts", F.when(F.col("k") % 13 > 1, F.col("ts")))
    by = ["source", "event_type"]
    counts = timed.groupBy(*by).agg(F.count("*").alias("rows"), F.count("dropped_by").alias("dropped"))
    return prg.next_cursor(timed, by, "ts", "event_id").join(counts, by)


@query(
    "boundary_ids",
    """WITH days AS (SELECT event_id, event_type, date_trunc('day', ts) AS ts FROM events)
      SELECT event_type, event_id FROM days QUALIFY ts = max(ts) OVER (PARTITION BY event_type)""",
)
def boundary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ids at the watermark instant, without a cap."""
    rows = raw_events(spark, sf_dir).select("event_id", "event_type", F.date_trunc("day", "ts").alias("ts"))
    cursor = prg.next_cursor(rows, ["event_type"], "ts", "event_id")
    return prg.boundary_ids(rows, cursor, ["event_type"], "ts", "event_id")


_LEDGER_SQL = """ledger AS (SELECT event_type || ':' || user_id AS key, CAST(event_id AS VARCHAR) AS value,
  event_id AS seq, json_extract_string(props, '$.k') = '7' AS deleted FROM events)"""


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger with a row per event; some rows are tombstones."""
    return raw_events(spark, sf_dir).select(
        F.concat_ws(":", "event_type", "user_id").alias("key"),
        F.col("event_id").cast("string").alias("value"),
        F.col("event_id").alias("seq"),
        (F.col("k") == 7).alias("deleted"),
    )


@query(
    "last_token_per_key",
    f"WITH {_LEDGER_SQL} SELECT key, max_by(value, seq) AS value, max(seq) AS seq FROM ledger GROUP BY key",
)
def last_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prg.last_token_per_key(_ledger(spark, sf_dir))


@query(
    "show_progress",
    f"""WITH {_LEDGER_SQL} SELECT key, arg_max(value, seq) AS value FROM ledger
      WHERE regexp_full_match(key, 'c.*:1.*') GROUP BY key HAVING NOT arg_max(deleted, seq)""",
)
def show_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prg.show_progress(_ledger(spark, sf_dir), "c*:1*")


@query(
    "edit_progress",
    f"""WITH {_LEDGER_SQL} SELECT key, CASE WHEN key = 'view:3' THEN 'repaired' ELSE arg_max(value, seq) END AS value
      FROM ledger WHERE key <> 'view:5' GROUP BY key HAVING key = 'view:3' OR NOT arg_max(deleted, seq)""",
)
def edit_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key repaired, one deleted."""
    ledger = prg.set_progress(_ledger(spark, sf_dir), "view:3", "repaired")
    return prg.show_progress(prg.delete_progress(ledger, "view:5"))


@query(
    "org_progress",
    f"""WITH {_LEDGER_SQL}, current AS (SELECT key, arg_max(value, seq) AS value FROM ledger
        GROUP BY key HAVING NOT arg_max(deleted, seq)),
      prefixed AS (SELECT 'org=' || CASE WHEN CAST(split_part(key, ':', 2) AS INT) % 2 = 0 THEN 'emea' ELSE 'apac' END
        || ':' || key AS key, value FROM current WHERE key LIKE 'click:%'
        UNION ALL SELECT key, value FROM current WHERE key LIKE 'error:%')
      SELECT k.key, coalesce(p.value, o.value) AS value FROM (SELECT DISTINCT key FROM ledger) k
      LEFT JOIN prefixed p ON p.key = 'org=emea:' || k.key LEFT JOIN prefixed o ON o.key = k.key""",
)
def org_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first org sees its own keys and, where it has none, those from before orgs had names."""
    ledger = _ledger(spark, sf_dir)
    clicks = ledger.filter(F.col("key").startswith("click:"))
    user = F.split("key", ":")[1].cast("int")
    mixed = (
        prg.prefix_keys(clicks.filter(user % 2 == 0), "emea")
        .unionByName(prg.prefix_keys(clicks.filter(user % 2 == 1), "apac"))
        .unionByName(ledger.filter(F.col("key").startswith("error:")))
    )
    return prg.org_progress(mixed, "emea", ledger.select("key").distinct(), take_unprefixed=True)


@query(
    "watermark_lag",
    """SELECT event_type, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 1e6 AS lag_seconds
      FROM events GROUP BY 1""",
)
def watermark_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    cursor = prg.next_cursor(raw_events(spark, sf_dir), ["event_type"], "ts", "event_id")
    return quality.watermark_lag(cursor, ["event_type"], "2024-02-01")
