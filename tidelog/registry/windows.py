"""Running values, budgets, streaks, batches (WIN, SNK-2, SNK-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.labels import text_map
from tidelog.functions.payload import canonical_line
from tidelog.functions.text import line_bytes
from tidelog.operators import budget, streaks
from tidelog.operators.packing import assign_batches
from tidelog.registry.base import query
from tidelog.registry.tables import E_SQL, filled_entries, raw_events, table
from tidelog.sinks.payloads import batched, push_payloads

ORDER = ["ts", "event_id"]


@query(
    "fill_last_good",
    """WITH t AS (SELECT event_id, event_type, CASE WHEN value > 12 THEN NULL ELSE ts END AS seen FROM events)
      SELECT event_id, last_value(seen IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY event_id
        ROWS UNBOUNDED PRECEDING) AS filled_ts FROM t""",
)
def fill_last_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_events(spark, sf_dir).select(
        "event_id", "event_type", F.when(~(F.col("value") > 12), F.col("ts")).alias("seen")
    )
    return streaks.fill_last_good(rows, ["event_type"], ["event_id"], "seen").select("event_id", "filled_ts")


@query(
    "ingest_clock",
    """SELECT event_id, TIMESTAMP '2024-02-01' + to_microseconds(row_number() OVER (ORDER BY event_type, ts, event_id) - 1)
      AS ingest_ts FROM events""",
)
def ingest_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_events(spark, sf_dir).select("event_type", "ts", "event_id")
    return streaks.ingest_clock(rows, ["event_type", "ts", "event_id"], "2024-02-01").select(
        "event_id", "ingest_ts"
    )


BUDGET = 2500.0
_SIZED_SQL = "sized AS (SELECT event_id, ts, CAST(floor(value) AS BIGINT) + 1 AS line_bytes FROM events)"
_BUDGET_SQL = (
    f"{_SIZED_SQL}, used AS (SELECT *, CAST(ts AS DATE) AS day, CAST(sum(line_bytes) OVER "
    "(PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS used FROM sized)"
)


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(spark, sf_dir).select(
        "event_id", "ts", (F.floor("value").cast("bigint") + 1).alias("line_bytes")
    )


@query(
    "daily_budget",
    f"WITH {_BUDGET_SQL} SELECT event_id, ts, used > {BUDGET} AS over_budget FROM used",
)
def daily_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a day are kept until the running size passes the budget."""
    rows = budget.apply_daily_budget(_sized(spark, sf_dir), int(BUDGET), ORDER)
    return rows.select("event_id", "ts", "over_budget")


@query(
    "budget_report",
    f"""WITH {_BUDGET_SQL} SELECT day, CAST(coalesce(sum(line_bytes) FILTER (used <= {BUDGET}), 0) AS BIGINT) AS used_bytes,
      CAST(coalesce(sum(line_bytes) FILTER (used > {BUDGET}), 0) AS BIGINT) AS dropped_bytes,
      count(*) FILTER (used > {BUDGET}) AS dropped_rows,
      min(ts) FILTER (used >= 0.8 * {BUDGET} AND used <= {BUDGET}) AS warned_at FROM used GROUP BY day""",
)
def budget_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.budget_report(_sized(spark, sf_dir), int(BUDGET), ORDER)


@query(
    "budget_hold",
    f"""WITH RECURSIVE {_SIZED_SQL},
      line AS (SELECT *, CAST(sum(line_bytes) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM sized),
      span AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b, sum(line_bytes) AS t FROM sized),
      days AS (SELECT CAST(unnest(generate_series(a, CAST(b + to_days(CAST(ceil(t / {BUDGET}) AS INT) + 1) AS DATE), INTERVAL 1 DAY)) AS DATE) AS day FROM span),
      arrived AS (SELECT d.day, coalesce((SELECT max(upto) FROM line WHERE CAST(ts AS DATE) <= d.day), 0) AS arrived FROM days d),
      served AS (SELECT day, least(arrived, {BUDGET}) AS served FROM arrived WHERE day = (SELECT a FROM span)
        UNION ALL SELECT n.day, least(n.arrived, s.served + {BUDGET}) FROM served s JOIN arrived n ON n.day = s.day + 1)
      SELECT event_id, (SELECT min(day) FROM served s WHERE s.served >= l.upto) AS deliver_on FROM line l""",
)
def budget_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over-budget rows wait in line for the next day's budget."""
    return budget.hold_over_budget(_sized(spark, sf_dir), int(BUDGET), ORDER).select("event_id", "deliver_on")


CAP = 0.02
_LAG_SQL = f"""paced AS (SELECT event_id, ts, epoch_us(ts) / 1e6 AS a,
    row_number() OVER (ORDER BY ts, event_id) / {CAP} AS s FROM events),
  peaks AS (SELECT *, max(a - (s - 1 / {CAP})) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS peak FROM paced)"""


@query(
    "rate_cap_lag",
    f"WITH {_LAG_SQL} SELECT event_id, CAST(round(greatest(0, s + peak - 1 - a), 3) AS DOUBLE) AS delay FROM peaks",
)
def rate_cap_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds behind a cap in lines per second."""
    rows = raw_events(spark, sf_dir).select("event_id", "ts")
    return budget.rate_cap_lag(rows, ORDER, F.lit(1), CAP).select("event_id", F.round("delay", 3).alias("delay"))


@query(
    "rate_cap_report",
    f"""WITH {_SIZED_SQL}, a AS (SELECT *, epoch_us(ts) / 1e6 AS a,
        row_number() OVER w / 0.1 AS s1, CAST(sum(line_bytes) OVER w AS BIGINT) / 1.0 AS s2
        FROM sized WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
      p AS (SELECT *, max(a - (s1 - 1 / 0.1)) OVER w AS p1, max(a - (s2 - line_bytes / 1.0)) OVER w AS p2
        FROM a WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
      d AS (SELECT CAST(ts AS DATE) AS day, line_bytes, round(greatest(0, s1 + p1 - 1 - a), 3) AS d1,
        round(greatest(0, s2 + p2 - 1 - a), 3) AS d2 FROM p)
      SELECT day, count(*) AS lines, CAST(sum(line_bytes) AS BIGINT) AS bytes, CAST(max(d1) AS DOUBLE) AS max_line_delay,
        CAST(max(d2) AS DOUBLE) AS max_byte_delay, count(*) FILTER (greatest(d1, d2) > 0) AS delayed FROM d GROUP BY 1""",
)
def rate_cap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = budget.rate_cap_report(_sized(spark, sf_dir), ORDER, "line_bytes", 0.1, 1.0)
    return report.withColumns({c: F.round(c, 3) for c in ("max_line_delay", "max_byte_delay")})


@query(
    "failure_streaks",
    """WITH t AS (SELECT event_type, event_id, value > 8 AS failed, sum(CASE WHEN value > 8 THEN 0 ELSE 1 END)
        OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS island FROM events)
      SELECT event_type, count(*) AS failures, min(event_id) AS first_event_id, max(event_id) AS last_event_id
      FROM t WHERE failed GROUP BY event_type, island HAVING count(*) >= 8""",
)
def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return streaks.failure_streaks(rows, ["event_type"], ["event_id"], F.col("value") > 8, 8)


@query(
    "conversation_streaks",
    """WITH t AS (SELECT conv_id, turn, length(text) > 200 AS failed, sum(CASE WHEN length(text) > 200 THEN 0 ELSE 1 END)
        OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS island FROM conversations)
      SELECT conv_id, count(*) AS failures, min(turn) AS first_turn, max(turn) AS last_turn
      FROM t WHERE failed GROUP BY conv_id, island HAVING count(*) >= 2""",
)
def conversation_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return streaks.failure_streaks(rows, ["conv_id"], ["turn"], F.length("text") > 200, 2)


@query(
    "stalls",
    """WITH c AS (SELECT event_type, event_id, time_bucket(INTERVAL 2 HOUR, ts) AS watermark FROM events),
      l AS (SELECT *, lag(watermark) OVER (PARTITION BY event_type ORDER BY event_id) AS previous FROM c)
      SELECT event_type, event_id, watermark FROM l WHERE previous = watermark""",
)
def stalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_events(spark, sf_dir).select(
        "event_type", "event_id", F.window("ts", "2 hours")["start"].alias("watermark")
    )
    return streaks.stalls(rows, ["event_type"], ["event_id"], "watermark").drop("previous")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filled_entries(spark, sf_dir).withColumn("line", canonical_line(F.col("payload")))
    return rows.withColumn("line_bytes", line_bytes(F.col("line")))


@query(
    "batches_by_count",
    f"""WITH {E_SQL} SELECT source, event_id, (row_number() OVER (PARTITION BY source ORDER BY ts, event_id) - 1) // 100 AS batch_no FROM e""",
)
def batches_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = assign_batches(_lines(spark, sf_dir), ["source"], ORDER, max_entries=100, max_bytes=0)
    return batches.select("source", "event_id", "batch_no")


@query(
    "batches_greedy",
    f"""WITH RECURSIVE {E_SQL}, n AS MATERIALIZED (SELECT event_type, event_id, octet_length(encode(line)) AS b,
        row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM e),
      walk AS (SELECT event_type, i, event_id, 1 AS held, b AS bytes, 0::BIGINT AS batch_no FROM n WHERE i = 1
        UNION ALL SELECT n.event_type, n.i, n.event_id,
          CASE WHEN w.held >= 20 OR w.bytes + n.b > 5000 THEN 1 ELSE w.held + 1 END,
          CASE WHEN w.held >= 20 OR w.bytes + n.b > 5000 THEN n.b ELSE w.bytes + n.b END,
          w.batch_no + CASE WHEN w.held >= 20 OR w.bytes + n.b > 5000 THEN 1 ELSE 0 END
        FROM walk w JOIN n ON n.event_type = w.event_type AND n.i = w.i + 1)
      SELECT event_type, event_id, batch_no FROM walk""",
)
def batches_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact greedy batches of at most 20 entries and 5,000 bytes."""
    batches = assign_batches(_lines(spark, sf_dir), ["event_type"], ORDER, max_entries=20, max_bytes=5000)
    return batches.select("event_type", "event_id", "batch_no")


_PUSH_SQL = f"""{E_SQL}, n AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY ts, event_id) - 1) // 50 AS batch_no FROM e)
  SELECT '{{"source":"' || source || '"}}' AS stream_key, batch_no, count(*) AS entries,
    CAST(sum(octet_length(encode(line))) AS BIGINT) AS bytes,
    '{{"stream":{{"source":"' || source || '"}},"values":[' || string_agg('["' || epoch_us(ts) * 1000 || '","' ||
      replace(line, '"', '\\"') || '",{{"USER_ID":"' || f_USER_ID || '"}}]', ',' ORDER BY ts, event_id) || ']}}' AS document
  FROM n GROUP BY source, batch_no"""


@query("push_payloads", f"WITH {_PUSH_SQL}")
def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per stream and batch of 50."""
    rows = _lines(spark, sf_dir).select(
        "ts", "event_id", "line",
        text_map({"source": F.col("source")}).alias("labels"),
        text_map({"USER_ID": F.col("payload").getItem("USER_ID")}).alias("metadata"),
    )
    return push_payloads(batched(rows, ORDER, max_entries=50, max_bytes=10_000_000), ORDER)
