"""The test tables read as audit logs.

`events` plays the event source, `orders` the file catalogue, `documents` free text and debug-log
bodies, `conversations` ordered topics. The derivations are plain SQL that both engines read, so one
text serves both sides; the operators under test are written separately for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- events ---------------------------------------------------------------------------------

K = {"spark": "CAST(get_json_object(props, '$.k') AS INT)",
     "duck": "CAST(json_extract_string(props, '$.k') AS INT)"}

ENVELOPE = {
    "event_id": "event_id",
    "ts": "ts",
    "user_id": "user_id",
    "value": "value",
    "k": "k",
    "event_type": "CASE event_type WHEN 'signup' THEN 'Login' WHEN 'click' THEN 'ApexCallout' "
    "WHEN 'purchase' THEN 'ApiTotalUsage' WHEN 'view' THEN 'LoginEventStream' ELSE 'ApiEvent' END",
    "source": "CASE event_type WHEN 'view' THEN 'pubsub' WHEN 'error' THEN 'eventlog_objects' "
    "ELSE 'eventlogfile' END",
    "org": "concat('org', CAST(user_id % 3 AS VARCHAR(20)))",
}

# Names of payload fields and the status words the alerts look for. Null means the event type has no
# such field.
PAYLOAD = {
    "API_FAMILY": "CASE WHEN event_type = 'purchase' THEN CASE k % 4 WHEN 0 THEN 'REST' "
    "WHEN 1 THEN 'SOAP' WHEN 2 THEN 'BULK' ELSE '' END END",
    "CLIENT_IP": "CASE WHEN k % 9 = 0 THEN '' ELSE concat('10.', CAST(user_id % 8 AS VARCHAR(20)), "
    "'.', CAST(k % 5 AS VARCHAR(20)), '.', CAST(user_id % 250 AS VARCHAR(20))) END",
    "COUNTRY": "CASE user_id % 6 WHEN 0 THEN 'US' WHEN 1 THEN 'DE' WHEN 2 THEN 'IN' WHEN 3 THEN 'BR' "
    "WHEN 4 THEN 'JP' ELSE '' END",
    "DB_TOTAL_TIME": "CASE WHEN k % 12 = 5 THEN 'n/a' ELSE "
    "CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR(20)) END",
    "EMAIL": "concat('user', CAST(user_id AS VARCHAR(20)), '@mail', CAST(k % 3 AS VARCHAR(20)), '.example')",
    "ERROR_CODE": "CASE WHEN event_type = 'error' THEN CASE WHEN k % 5 = 0 THEN 'LIMIT_EXCEEDED' "
    "WHEN k % 5 = 1 THEN '0' ELSE '' END END",
    "LOGIN_STATUS": "CASE WHEN event_type = 'signup' THEN CASE WHEN k % 4 = 0 THEN "
    "'LOGIN_ERROR_INVALID_PASSWORD' WHEN k % 10 = 1 THEN '' ELSE 'LOGIN_NO_ERROR' END END",
    "REQUEST_ID": "CASE WHEN event_type IN ('signup', 'click', 'purchase') THEN "
    "CASE WHEN k % 7 = 0 THEN '' ELSE concat('req-', CAST(event_id AS VARCHAR(20))) END END",
    "STATUS_CODE": "CASE WHEN event_type = 'error' THEN CAST(200 + (k % 4) * 100 AS VARCHAR(20)) END",
    "SUCCESS": "CASE WHEN event_type = 'click' THEN CASE WHEN k < 12 THEN '0' ELSE '1' END END",
    "Status": "CASE WHEN event_type = 'view' THEN CASE k % 3 WHEN 0 THEN 'Success' WHEN 1 THEN "
    "' failed: token ' ELSE 'N/A' END END",
    "TIME": "CASE WHEN event_type = 'click' THEN CASE WHEN k % 11 = 0 THEN '' ELSE "
    "CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR(20)) END END",
    "USER_ID": "concat('005', CAST(user_id AS VARCHAR(20)))",
}

# The event time as a file row would carry it: mostly ISO, some compact, some missing or broken.
TIME_TEXT = {
    "spark": "CASE k % 13 WHEN 0 THEN '' WHEN 1 THEN date_format(ts, 'yyyyMMddHHmmss.SSS') "
    "WHEN 2 THEN '2024' ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") END",
    "duck": "CASE k % 13 WHEN 0 THEN '' WHEN 1 THEN strftime(ts, '%Y%m%d%H%M%S.%g') "
    "WHEN 2 THEN '2024' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END",
}
PAYLOAD_NAMES = sorted([*PAYLOAD, "TIMESTAMP_DERIVED"])


def _fields(engine: str) -> dict[str, str]:
    return {**PAYLOAD, "TIMESTAMP_DERIVED": TIME_TEXT[engine]}


def _projection(engine: str) -> str:
    # Payload fields are prefixed: SQL names are case-insensitive, so STATUS and Status would clash.
    parts = [f"{sql} AS {name}" for name, sql in ENVELOPE.items()]
    parts += [f"{sql} AS f_{name}" for name, sql in _fields(engine).items()]
    return ", ".join(parts)


# SQL side: one row per event, payload fields as columns f_<NAME>, canonical JSON as `line`.
_RAW = f"raw AS (SELECT *, {K['duck']} AS k FROM events)"
_LINE = (
    "'{' || array_to_string(list_filter(["
    + ", ".join(f"'\"{n}\":\"' || f_{n} || '\"'" for n in PAYLOAD_NAMES)
    + "], lambda x: x IS NOT NULL), ',') || '}'"
)
E_SQL = (
    f"{_RAW}, fields AS (SELECT {_projection('duck')} FROM raw), "
    f"e AS (SELECT *, {_LINE} AS line FROM fields)"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The event table with a zoned time and the number inside its JSON.

    `spread` deals the rows out evenly first, for costly steps over files of few, large row groups.
    """
    read = table(spark, sf_dir, "events")
    return (read.repartition("event_id") if spread else read).withColumns(
        {"ts": F.col("ts").cast("timestamp"), "k": F.expr(K["spark"])}
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope and payload map. Fields of a literal map are pruned like columns."""
    raw = raw_events(spark, sf_dir)
    pairs = [c for n, sql in sorted(_fields("spark").items()) for c in (F.lit(n), F.expr(sql))]
    return raw.select(
        *[F.expr(sql).alias(name) for name, sql in ENVELOPE.items()],
        F.create_map(*pairs).alias("payload"),
    )


def filled_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `entries`, without the fields an event type does not have."""
    return entries(spark, sf_dir).withColumn(
        "payload", F.map_filter("payload", lambda _, v: v.isNotNull())
    )


# --- file catalogue ---------------------------------------------------------------------------

_FILE_TYPE = (
    "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Login' WHEN '2' THEN 'API' WHEN '3' THEN "
    "'Apex Callout' WHEN '4' THEN 'Report' ELSE 'URI' END"
)
_FILE_COLUMNS = {
    "Id": "concat('0AT', lpad(CAST(o_orderkey AS VARCHAR(20)), 9, '0'))",
    "EventType": f"CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE {_FILE_TYPE} END",
    "Interval": "CASE WHEN o_orderkey % 3 = 0 THEN 'Daily' ELSE 'Hourly' END",
    "LogFileLength": "CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 17 = 1 THEN 'bad' "
    "ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR(20)) || '.0' END",
    "Sequence": "CASE WHEN o_orderkey % 2 = 0 THEN '2' END",
}
_CREATED = "o_orderdate + INTERVAL '1' MINUTE * (o_orderkey % 1440)"
_FILES_DUCK = ", ".join(f'{sql} AS "{name}"' for name, sql in _FILE_COLUMNS.items())
FILES_SQL = (
    f"versions AS (SELECT *, {_CREATED} AS made, 0 AS version FROM orders UNION ALL "
    f"SELECT *, {_CREATED} + INTERVAL '1' DAY AS made, 1 AS version FROM orders "
    "WHERE o_orderkey % 10 = 0), "
    f"files AS (SELECT {_FILES_DUCK}, made AS created, version, o_custkey, o_orderstatus FROM versions)"
)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue row per file version; every tenth file was regenerated a day later."""
    orders = table(spark, sf_dir, "orders")
    minutes = F.make_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    at = F.col("o_orderdate").cast("timestamp") + minutes
    first = orders.withColumns({"at": at, "version": F.lit(0)})
    again = first.filter("o_orderkey % 10 = 0").withColumns(
        {"at": F.col("at") + F.expr("INTERVAL 1 DAY"), "version": F.lit(1)}
    )
    created = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'")
    return first.unionByName(again).select(
        *[F.expr(sql).alias(name) for name, sql in _FILE_COLUMNS.items()],
        created.alias("CreatedDate"),
        "version",
        "o_custkey",
        "o_orderstatus",
    )
