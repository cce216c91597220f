"""The overview dashboard (Q), recording rules (R) and exploration (X)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.payload import canonical_line
from tidelog.operators.rules import Rule, apply_rules
from tidelog.plans import dashboard, explore, recording
from tidelog.registry.base import query
from tidelog.registry.tables import E_SQL, entries, filled_entries

RANGE_SECONDS = 30 * 86_400


@query("events_ingested", "SELECT count(*) AS events FROM events")
def events_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.events_ingested(entries(spark, sf_dir))


@query("event_rate", f"SELECT count(*) / {RANGE_SECONDS}.0::DOUBLE AS rate FROM events")
def event_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.event_rate(entries(spark, sf_dir), RANGE_SECONDS)


@query("active_event_types", f"WITH {E_SQL} SELECT count(DISTINCT event_type) AS event_types FROM e")
def active_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.active_event_types(entries(spark, sf_dir))


@query("active_sources", f"WITH {E_SQL} SELECT count(DISTINCT source) AS sources FROM e")
def active_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.active_sources(entries(spark, sf_dir))


@query(
    "rate_by_source",
    f"""WITH {E_SQL} SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS step_start, source, count(*) / 300.0::DOUBLE AS rate
      FROM e GROUP BY 1, 2""",
)
def rate_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.rate_by_source(entries(spark, sf_dir), "5 minutes", 300)


@query(
    "top_types_by_rate",
    f"""WITH {E_SQL} SELECT time_bucket(INTERVAL 1 HOUR, ts) AS step_start, event_type, count(*) / 3600.0::DOUBLE AS rate,
      CAST(row_number() OVER (PARTITION BY time_bucket(INTERVAL 1 HOUR, ts) ORDER BY count(*) DESC, event_type) AS INT) AS rank
      FROM e GROUP BY 1, 2 QUALIFY rank <= 3""",
)
def top_types_by_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.top_types_by_rate(entries(spark, sf_dir), "1 hour", 3600, k=3)


@query("volume_by_type", f"WITH {E_SQL} SELECT event_type, count(*) AS n FROM e GROUP BY 1")
def volume_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.volume_by_type(entries(spark, sf_dir))


@query("events_by_org", f"WITH {E_SQL} SELECT org, count(*) AS n FROM e GROUP BY 1")
def events_by_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.events_by_org(entries(spark, sf_dir))


@query(
    "top_clients",
    f"""WITH {E_SQL} SELECT f_CLIENT_IP AS client_ip, count(*) AS n FROM e
      WHERE source = 'eventlogfile' AND f_CLIENT_IP <> '' GROUP BY 1 ORDER BY n DESC, client_ip LIMIT 15""",
)
def top_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.top_clients(entries(spark, sf_dir))


@query(
    "top_clients_from_lines",
    f"""WITH {E_SQL} SELECT f_CLIENT_IP AS client_ip, count(*) AS n FROM e
      WHERE source = 'eventlogfile' AND f_CLIENT_IP <> '' GROUP BY 1 ORDER BY n DESC, client_ip LIMIT 15""",
)
def top_clients_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same panel over stored lines: the one field it needs is extracted from the JSON."""
    lines = filled_entries(spark, sf_dir).select("ts", "source", canonical_line(F.col("payload")).alias("line"))
    return dashboard.top_clients(lines)


@query(
    "recent_events",
    f"WITH {E_SQL} SELECT event_id, ts, event_type FROM e ORDER BY ts DESC, event_id LIMIT 100",
)
def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.recent_events(entries(spark, sf_dir), 100, "event_id").select("event_id", "ts", "event_type")


# --- recording rules ----------------------------------------------------------------------------

W5 = "time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end"


@query(
    "login_failures_5m",
    f"""WITH {E_SQL} SELECT {W5}, count(*) AS n FROM e WHERE event_type = 'Login' AND source = 'eventlogfile'
      AND f_LOGIN_STATUS NOT IN ('', 'LOGIN_NO_ERROR') GROUP BY 1, 2""",
)
def login_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recording.login_failures(entries(spark, sf_dir))


@query(
    "callout_errors_5m",
    f"""WITH {E_SQL} SELECT {W5}, count(*) AS n FROM e WHERE event_type = 'ApexCallout' AND f_SUCCESS = '0' GROUP BY 1, 2""",
)
def callout_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recording.callout_errors(entries(spark, sf_dir))


@query(
    "events_by_source_and_type_5m",
    f"WITH {E_SQL} SELECT {W5}, source, event_type, count(*) AS n FROM e GROUP BY 1, 2, 3, 4",
)
def events_by_source_and_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recording.events_by_source_and_type(entries(spark, sf_dir))


@query(
    "api_usage_by_family_5m",
    f"""WITH {E_SQL} SELECT {W5}, f_API_FAMILY AS api_family, count(*) AS n FROM e
      WHERE event_type = 'ApiTotalUsage' GROUP BY 1, 2, 3""",
)
def api_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recording.api_usage_by_family(entries(spark, sf_dir))


# --- exploration --------------------------------------------------------------------------------


@query(
    "login_status_breakdown",
    f"""WITH {E_SQL} SELECT f_LOGIN_STATUS AS login_status, count(*) AS n FROM e
      WHERE event_type = 'Login' AND f_LOGIN_STATUS <> '' GROUP BY 1""",
)
def login_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.login_status_breakdown(entries(spark, sf_dir))


@query(
    "country_count",
    f"WITH {E_SQL} SELECT count(DISTINCT f_COUNTRY) AS countries FROM e WHERE f_COUNTRY <> ''",
)
def country_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.country_count(entries(spark, sf_dir))


@query(
    "events_by_country",
    f"WITH {E_SQL} SELECT f_COUNTRY AS country, count(*) AS n FROM e WHERE f_COUNTRY <> '' GROUP BY 1",
)
def events_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.events_by_country(entries(spark, sf_dir))


@query(
    "callout_latency",
    f"WITH {E_SQL} "
    + " UNION ALL ".join(
        f"SELECT event_type, {q}::DOUBLE AS q, quantile_cont(try_cast(f_TIME AS DOUBLE), {q}) AS value "
        "FROM e WHERE event_type = 'ApexCallout' GROUP BY 1"
        for q in (0.5, 0.95, 0.99)
    ),
)
def callout_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.callout_latency(entries(spark, sf_dir))


@query(
    "db_time_by_type",
    f"WITH {E_SQL} SELECT event_type, avg(try_cast(f_DB_TOTAL_TIME AS DOUBLE)) AS average FROM e GROUP BY 1",
)
def db_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.db_time_by_type(entries(spark, sf_dir))


@query(
    "drop_rate_by_type",
    f"""WITH {E_SQL} SELECT time_bucket(INTERVAL 1 HOUR, ts) AS step_start, event_type, count(*) / 3600.0::DOUBLE AS rate
      FROM e WHERE f_COUNTRY = 'US' OR f_CLIENT_IP LIKE '10.7.%' GROUP BY 1, 2""",
)
def drop_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [Rule("drop_row", match={"COUNTRY": "US"}), Rule("drop_row", match={"CLIENT_IP": "10.7.*"})]
    dropped = apply_rules(entries(spark, sf_dir), rules).filter(F.col("dropped_by").isNotNull())
    return explore.drop_rate_by_type(dropped, "1 hour", 3600)
