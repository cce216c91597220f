"""Alert rules (A, WIN-7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.labels import text_map
from tidelog.operators.series import trailing_counts
from tidelog.plans import alerting
from tidelog.registry.base import query
from tidelog.registry.joins import LIMITS_SQL, limit_snapshots
from tidelog.registry.tables import E_SQL, entries, raw_events, table
from tidelog.schema import LAG_BOUNDS
from tidelog.sources.orgs import load_limits


def _ticks_sql(rows: str, measures: str, range_minutes: int, tick_minutes: int, by: str = "") -> str:
    """Every tick evaluated over the rows of its range, straight from the definition."""
    return f"""SELECT tick, {by} {measures} FROM ({rows}) r,
      (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-02', to_minutes({tick_minutes}))) AS tick) t
      WHERE ts < tick AND ts >= tick - to_minutes({range_minutes}) GROUP BY ALL"""


def _pending_sql(ticks: str, condition: str, hold: int, tick_minutes: int) -> str:
    return f"""ticks AS ({ticks}), spans AS (SELECT tick, tick - to_minutes({tick_minutes} * CAST(row_number() OVER (ORDER BY tick) AS INT)) AS span
        FROM ticks WHERE {condition})
      SELECT min(tick) AS pending_since, min(tick) + to_minutes({hold}) AS firing_at, max(tick) AS last_true, count(*) AS ticks
      FROM spans GROUP BY span HAVING max(tick) >= min(tick) + to_minutes({hold})"""


_FAILED = "SELECT ts FROM e WHERE event_type = 'Login' AND f_LOGIN_STATUS NOT IN ('', 'LOGIN_NO_ERROR')"


@query(
    "trailing_counts",
    f"WITH {E_SQL} " + _ticks_sql("SELECT ts, source FROM e", "count(*) AS n", 120, 30, "source,"),
)
def trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over the last two hours, every half hour and per source."""
    return trailing_counts(entries(spark, sf_dir), 120, 30, ["source"])


@query(
    "login_failure_spike",
    f"WITH {E_SQL}, " + _pending_sql(_ticks_sql(_FAILED, "count(*) AS n", 1440, 30), "n > 18", 180, 30),
)
def login_failure_spike(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is sparse, so a day is counted every half hour, pending for three hours."""
    return alerting.login_failure_spike(
        entries(spark, sf_dir), threshold=18, range_minutes=1440, hold_minutes=180, tick_minutes=30
    )


@query(
    "login_failure_spike_10m",
    f"WITH {E_SQL}, " + _pending_sql(_ticks_sql(_FAILED, "count(*) AS n", 10, 1), "n > 0", 5, 1),
)
def login_failure_spike_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule's own range, evaluation interval and hold, at a threshold this table reaches."""
    return alerting.login_failure_spike(entries(spark, sf_dir), threshold=0)


_CALLS = "SELECT ts, f_SUCCESS FROM e WHERE event_type = 'ApexCallout'"
_PERCENT = "CAST(count(*) FILTER (f_SUCCESS = '0') AS BIGINT) AS errors, count(*) AS calls, count(*) FILTER (f_SUCCESS = '0') / count(*) * 100 AS percent"


@query("callout_error_rate", f"WITH {E_SQL} " + _ticks_sql(_CALLS, _PERCENT, 60, 10))
def callout_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerting.callout_error_rate(entries(spark, sf_dir), 60, 10)


@query(
    "callout_error_alerts",
    f"WITH {E_SQL}, " + _pending_sql(_ticks_sql(_CALLS, _PERCENT, 720, 30), "percent > 10", 120, 30),
)
def callout_error_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerting.callout_error_alerts(
        entries(spark, sf_dir), threshold=10.0, range_minutes=720, hold_minutes=120, tick_minutes=30
    )


@query(
    "api_headroom_low",
    f"WITH {LIMITS_SQL} SELECT min(remaining / max) * 100 AS min_percent, min(remaining / max) * 100 < 10 AS firing FROM limits",
)
def api_headroom_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerting.api_headroom_low(load_limits(limit_snapshots(spark, sf_dir)))


@query(
    "ingest_lag_high",
    f"""WITH {E_SQL}, hist AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS step_start, source, le,
        count(*) FILTER (value * 20 <= le) AS n FROM e,
        (SELECT unnest([{', '.join(f'{b}::DOUBLE' for b in LAG_BOUNDS)}, 'infinity'::DOUBLE]) AS le) b GROUP BY ALL),
      ordered AS (SELECT *, max(n) OVER (PARTITION BY step_start, source) AS total,
        coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(n) OVER w, 0) AS before
        FROM hist WINDOW w AS (PARTITION BY step_start, source ORDER BY le)),
      first AS (SELECT * FROM ordered WHERE n >= 0.95::DOUBLE * total
        QUALIFY row_number() OVER (PARTITION BY step_start, source ORDER BY le) = 1),
      result AS (SELECT step_start, source, CASE WHEN isinf(le) THEN low ELSE
        low + (le - low) * ((0.95::DOUBLE * total - before) / (n - before)) END AS quantile FROM first)
      SELECT *, quantile > 900 AS firing FROM result""",
)
def ingest_lag_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerting.ingest_lag_high(entries(spark, sf_dir), F.col("value") * 20, "6 hours")


@query(
    "delivery_failing",
    """WITH s AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS step_start,
        count(*) FILTER (event_type = 'error') / 300.0::DOUBLE AS failed, count(*) / 300.0::DOUBLE AS total FROM events GROUP BY 1),
      p AS (SELECT step_start, failed / greatest(total, 0.0001::DOUBLE) * 100 AS percent FROM s)
      SELECT step_start, percent, percent > 5 AS firing FROM p""",
)
def delivery_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerting.delivery_failing(raw_events(spark, sf_dir), F.col("event_type") != "error")


@query(
    "no_recent_delivery",
    """SELECT max(ts) AS last_success, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 1e6 AS age_seconds,
      (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 1e6 > 600 AS firing FROM events WHERE event_type <> 'error'""",
)
def no_recent_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivered = raw_events(spark, sf_dir).filter("event_type <> 'error'")
    return alerting.no_recent_delivery(delivered, "2024-01-31")


@query(
    "writer_count_anomaly",
    """WITH g AS (SELECT o_orderdate AS ts, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS writers
        FROM orders GROUP BY 1)
      SELECT ts, writers, abs(writers - 1) AS deviation, abs(writers - 1) > 0 AS firing FROM g""",
)
def writer_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    gauge = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("ts"), F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("value")
    )
    return alerting.writer_count_anomaly(gauge, ["ts"])


# --- the rules over metric frames, with their holds ---------------------------------------------


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as metrics: gauges per user and type, pushes by outcome, a lag histogram."""
    raw = raw_events(spark, sf_dir)

    def rows(name: str, attrs: dict[str, Column], value: Column, df: DataFrame = raw, le: Column | None = None) -> DataFrame:
        return df.select(
            "ts", F.lit(name).alias("name"), text_map(attrs).alias("attrs"), value.cast("double").alias("value"),
            (F.lit(None) if le is None else le).cast("double").alias("le"),
        )

    user = {"job": F.lit("audit"), "user": F.col("user_id").cast("string")}
    outcome = F.when(F.col("event_type") == "error", "failed").otherwise("success")
    bound = F.explode(F.array(*(F.lit(float(b)) for b in (*LAG_BOUNDS, float("inf")))))
    lags = raw.withColumn("bound", bound).filter(F.col("value") * 20 <= F.col("bound"))
    parts = [
        rows("remaining", user, F.col("k")),
        rows("max", user, F.lit(100)),
        rows("pushes", {"job": F.lit("audit"), "outcome": outcome}, F.lit(1)),
        rows("lag", {"job": F.lit("audit"), "source": F.col("event_type")}, F.lit(1), lags, F.col("bound")),
        rows("active", {"job": F.lit("audit"), "writer": F.col("event_type")}, (F.col("k") % 2)),
    ]
    return reduce(DataFrame.unionByName, parts)


def _gauge_sql(value: str, series: str, tick: int, stale: int) -> str:
    """The newest value of every series at every tick, straight from the definition."""
    return f"""SELECT tick, series, arg_max(value, ts) AS value FROM (SELECT ts, {series} AS series, {value} AS value FROM events) r,
      (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-05', to_minutes({tick}))) AS tick) t
      WHERE ts < tick AND time_bucket(to_minutes({tick}), ts) >= tick - to_minutes({stale}) GROUP BY 1, 2"""


_K = "CAST(json_extract_string(props, '$.k') AS INT)"


@query(
    "api_headroom_alerts",
    f"WITH g AS ({_gauge_sql(_K, 'user_id', 60, 720)}), "
    + _pending_sql("SELECT tick, min(value / 100) * 100 AS percent FROM g GROUP BY 1", "percent < 1.5", 300, 60),
)
def api_headroom_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerting.api_headroom_alerts(
        _metrics(spark, sf_dir), "remaining", "max", percent=1.5, hold_minutes=300, tick_minutes=60, stale_minutes=720, job="audit"
    )


@query(
    "ingest_lag_alerts",
    f"""WITH hist AS (SELECT tick, le, count(*) FILTER (value * 20 <= le) AS n FROM events,
        (SELECT unnest([{', '.join(f'{b}::DOUBLE' for b in LAG_BOUNDS)}, 'infinity'::DOUBLE]) AS le) b,
        (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-02', to_minutes(60))) AS tick) t
        WHERE ts < tick AND ts >= tick - to_minutes(360) AND value * 20 <= le GROUP BY ALL),
      ordered AS (SELECT *, max(n) OVER (PARTITION BY tick) AS total,
        coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(n) OVER w, 0) AS before
        FROM hist WINDOW w AS (PARTITION BY tick ORDER BY le)),
      first AS (SELECT * FROM ordered WHERE n >= 0.95::DOUBLE * total
        QUALIFY row_number() OVER (PARTITION BY tick ORDER BY le) = 1),
      q AS (SELECT tick, CASE WHEN isinf(le) THEN low ELSE
        low + (le - low) * ((0.95::DOUBLE * total - before) / (n - before)) END AS quantile FROM first), """
    + _pending_sql("SELECT * FROM q", "quantile > 900", 120, 60),
)
def ingest_lag_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerting.ingest_lag_alerts(
        _metrics(spark, sf_dir), "lag", range_minutes=360, hold_minutes=120, tick_minutes=60, job="audit"
    )


@query(
    "delivery_failing_alerts",
    "WITH "
    + _pending_sql(
        _ticks_sql("SELECT ts, event_type FROM events", "count(*) FILTER (event_type = 'error') / greatest(count(*), 0.0001::DOUBLE) * 100 AS percent", 120, 30),
        "percent > 20", 90, 30,
    ),
)
def delivery_failing_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerting.delivery_failing_alerts(
        _metrics(spark, sf_dir), "pushes", percent=20.0, range_minutes=120, hold_minutes=90, tick_minutes=30, job="audit"
    )


@query(
    "no_recent_delivery_alerts",
    "WITH "
    + _pending_sql(
        """SELECT tick, epoch(tick) - max(epoch(ts)) AS age FROM (SELECT ts FROM events WHERE event_type = 'click'),
        (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', to_minutes(10))) AS tick) t
        WHERE ts < tick GROUP BY 1""",
        "age > 3600", 60, 10,
    ),
)
def no_recent_delivery_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = raw_events(spark, sf_dir).filter("event_type = 'click'")
    return alerting.no_recent_delivery_alerts(clicks, "2024-01-31", 3600.0, hold_minutes=60, tick_minutes=10)


@query(
    "writer_count_alerts",
    f"WITH g AS ({_gauge_sql(_K + ' % 2', 'event_type', 30, 120)}), "
    + _pending_sql("SELECT tick, sum(value) AS writers FROM g GROUP BY 1", "abs(writers - 1) > 0", 90, 30),
)
def writer_count_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerting.writer_count_alerts(
        _metrics(spark, sf_dir), "active", hold_minutes=90, tick_minutes=30, stale_minutes=120, job="audit"
    )
