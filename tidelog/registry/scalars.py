"""Column builders (SCL), sampling and filters (FLT)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import globs, identity, severity, text, times
from tidelog.functions.labels import text_map
from tidelog.functions.payload import canonical_line, json_field, map_field
from tidelog.operators.sampling import (
    file_sample_key,
    object_sample_key,
    rate_by_glob,
    sample_rows,
    topic_sample_key,
)
from tidelog.operators.shape import event_time, time_by_source
from tidelog.plans.dashboard import in_range
from tidelog.registry.base import query
from tidelog.registry.tables import E_SQL, entries, filled_entries, raw_events, table
from tidelog.schema import TIME_FIELDS

NOW = "2024-01-31 00:00:00"

_PRESENT = "CASE WHEN lower(trim({0})) IN ('', '0', 'none', 'null', 'na', 'n/a') THEN NULL ELSE trim({0}) END"
_OK = "lower({0}) IN ('s', 'success', 'successful', 'ok', 'complete', 'completed', 'true')"


def _p(field: str) -> str:
    return _PRESENT.format(f"f_{field}")


LEVEL_SQL = f"""CASE
  WHEN {_p('ERROR_CODE')} IS NOT NULL THEN 'error'
  WHEN CAST({_p('STATUS_CODE')} AS INT) >= 500 THEN 'error'
  WHEN CAST({_p('STATUS_CODE')} AS INT) >= 400 THEN 'warn'
  WHEN CAST({_p('STATUS_CODE')} AS INT) >= 100 THEN 'info'
  WHEN {_p('LOGIN_STATUS')} IS NOT NULL THEN
    CASE WHEN upper({_p('LOGIN_STATUS')}) = 'LOGIN_NO_ERROR' THEN 'info' ELSE 'warn' END
  WHEN {_p('Status')} IS NOT NULL THEN
    CASE WHEN {_OK.format(_p('Status'))} THEN 'info' ELSE 'warn' END
  ELSE 'info' END"""

PARSED_SQL = (
    "coalesce(try_strptime(f_TIMESTAMP_DERIVED, '%Y-%m-%dT%H:%M:%S.%gZ'), "
    "try_strptime(f_TIMESTAMP_DERIVED, '%Y%m%d%H%M%S.%g'))"
)

BUCKET_SQL = "CAST(CAST('0x' || substr(sha256({0}), 1, 16) AS UBIGINT) % 10000 AS BIGINT)"


@query("derive_level", f"WITH {E_SQL} SELECT event_id, {LEVEL_SQL} AS level FROM e")
def derive_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(spark, sf_dir).select(
        "event_id", severity.derive_level(map_field()).alias("level")
    )


@query(
    "present_field",
    f"WITH {E_SQL} SELECT event_id, {_p('Status')} AS status, {_p('COUNTRY')} AS country FROM e",
)
def present_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = map_field()
    return entries(spark, sf_dir).select(
        "event_id",
        severity.present(field("Status")).alias("status"),
        severity.present(field("COUNTRY")).alias("country"),
    )


@query(
    "parse_event_time",
    f"WITH {E_SQL} SELECT event_id, {PARSED_SQL} AS parsed FROM e",
)
def parse_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(spark, sf_dir).select(
        "event_id", times.parse_event_time(map_field()("TIMESTAMP_DERIVED")).alias("parsed")
    )


@query(
    "parse_numeric_time",
    """SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS from_number,
    CAST(NULL AS TIMESTAMP) AS from_text FROM events""",
)
def parse_numeric_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number is epoch millis by its type; the same digits as text are no time."""
    raw = raw_events(spark, sf_dir)
    millis = F.unix_millis("ts")
    body = F.parse_json(
        F.concat(F.lit('{"n":'), millis.cast("string"), F.lit(',"t":"'), millis.cast("string"), F.lit('"}'))
    )
    return raw.select("event_id", body.alias("body")).select(
        "event_id",
        times.parse_variant_time(F.col("body"), "$.n").alias("from_number"),
        times.parse_variant_time(F.col("body"), "$.t").alias("from_text"),
    )


_FALLBACK_SQL = (
    f"CASE WHEN ts < TIMESTAMP '{NOW}' - INTERVAL 1 HOUR THEN TIMESTAMP '{NOW}' - INTERVAL 5 MINUTE ELSE ts END"
)


@query(
    "extract_event_time",
    f"""WITH {E_SQL} SELECT event_id, coalesce({PARSED_SQL}, {_FALLBACK_SQL}) AS event_time,
    {PARSED_SQL} IS NULL AS used_fallback FROM e""",
)
def extract_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, used = event_time(
        F.col("payload"), TIME_FIELDS["eventlogfile"], F.col("ts"), NOW
    )
    return entries(spark, sf_dir).select("event_id", ts.alias("event_time"), used.alias("used_fallback"))


@query(
    "time_field_order",
    f"""WITH {E_SQL} SELECT event_id, CASE
      WHEN source = 'eventlogfile' THEN {PARSED_SQL}
      WHEN k % 3 = 0 THEN date_trunc('second', ts)
      WHEN k % 3 = 1 THEN date_trunc('day', ts)
      WHEN source = 'pubsub' THEN make_timestamp(epoch_us(ts) // 1000 * 1000) END AS event_time FROM e""",
)
def time_field_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source has its own time fields; the first that parses counts."""
    raw = entries(spark, sf_dir)
    k = F.col("k") % 3
    own = F.create_map(
        F.lit("TIMESTAMP_DERIVED"), map_field()("TIMESTAMP_DERIVED"),
        F.lit("EventDate"), F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX")).otherwise("none"),
        F.lit("CreatedDate"), F.when(k == 1, F.date_format("ts", "yyyy-MM-dd")),
    )
    commit = F.when(k == 2, times.epoch_millis_time(F.unix_millis("ts")))

    def read(name: str) -> Column:
        return commit if name == "commitTimestamp" else times.parse_event_time(own.getItem(name))

    return raw.select("event_id", time_by_source(F.col("source"), read).alias("event_time"))


@query(
    "cap_line",
    """SELECT doc_id, octet_length(encode(text)) > 256 AS cut,
      CASE WHEN octet_length(encode(text)) <= 256 THEN text ELSE
        (SELECT max_by(left(text, n), n) FROM range(1, 257) t(n)
         WHERE octet_length(encode(left(text, CAST(n AS INT)))) <=
           256 - octet_length(encode('…[truncated, original ' || octet_length(encode(text)) || ' bytes]')))
        || '…[truncated, original ' || octet_length(encode(text)) || ' bytes]' END AS line
    FROM documents""",
)
def cap_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = text.line_bytes(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", (size > 256).alias("cut"), text.cap_line(F.col("text"), 256).alias("line")
    )


@query(
    "line_bytes",
    "SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS line_bytes FROM documents",
)
def line_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.line_bytes(F.col("text")).alias("line_bytes")
    )


@query(
    "entry_cost",
    f"""WITH {E_SQL} SELECT event_id, CAST(octet_length(encode(line)) + 64
      + length('source') + length(source) + length('event_type') + length(event_type)
      + length('USER_ID') + length(f_USER_ID)
      + coalesce(length('REQUEST_ID') + length(f_REQUEST_ID), 0)
      + length(CAST(event_id AS VARCHAR)) AS BIGINT) AS cost FROM e""",
)
def entry_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = map_field()
    labels = text_map({"source": F.col("source"), "event_type": F.col("event_type")})
    metadata = text_map({"USER_ID": field("USER_ID"), "REQUEST_ID": field("REQUEST_ID")})
    filled = filled_entries(spark, sf_dir).withColumn("line", canonical_line(F.col("payload")))
    cost = text.entry_cost(F.col("line"), labels, metadata, F.col("event_id").cast("string"))
    return filled.select("event_id", cost.alias("cost"))


_CATEGORY_SQL = """CASE WHEN s = 'loginhistory' THEN 'login' ELSE s END"""


@query(
    "event_category",
    f"""WITH {E_SQL}, named AS (SELECT event_id, source, CASE source
        WHEN 'pubsub' THEN '/event/' || event_type || '/'
        WHEN 'eventlog_objects' THEN CASE WHEN k % 2 = 0 THEN 'LoginHistory' ELSE event_type END
        ELSE CASE WHEN k % 2 = 0 THEN 'Login As' ELSE event_type END END AS name FROM e),
      stems AS (SELECT *, CASE
        WHEN source = 'eventlogfile' THEN replace(lower(name), ' ', '')
        ELSE lower(regexp_replace(regexp_extract(rtrim(name, '/'), '[^/]*$'), '(.)(EventStream|EventStore|Event)$', '\\1')) END AS s
        FROM named)
      SELECT event_id, name, {_CATEGORY_SQL} AS category FROM stems""",
)
def event_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("k") % 2 == 0
    name = (
        F.when(F.col("source") == "pubsub", F.concat(F.lit("/event/"), "event_type", F.lit("/")))
        .when((F.col("source") == "eventlog_objects") & even, F.lit("LoginHistory"))
        .when((F.col("source") == "eventlogfile") & even, F.lit("Login As"))
        .otherwise(F.col("event_type"))
    )
    named = entries(spark, sf_dir).select("event_id", "source", name.alias("name"))
    return named.select(
        "event_id", "name", identity.event_category(F.col("source"), F.col("name")).alias("category")
    )


@query(
    "utc_literal",
    f"""WITH {E_SQL} SELECT event_id,
      coalesce(strftime({PARSED_SQL}, '%Y-%m-%dT%H:%M:%S.%gZ'), f_TIMESTAMP_DERIVED) AS literal FROM e""",
)
def utc_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(spark, sf_dir).select(
        "event_id", times.utc_literal(map_field()("TIMESTAMP_DERIVED")).alias("literal")
    )


@query(
    "json_field",
    f"""WITH {E_SQL} SELECT event_id, json_extract_string(line, '$.CLIENT_IP') AS client_ip,
      json_extract_string(line, '$.LOGIN_STATUS') AS login_status FROM e""",
)
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = filled_entries(spark, sf_dir).withColumn("line", canonical_line(F.col("payload")))
    field = json_field()
    return lines.select(
        "event_id", field("CLIENT_IP").alias("client_ip"), field("LOGIN_STATUS").alias("login_status")
    )


@query("epoch_nanos", "SELECT event_id, CAST(epoch_us(ts) * 1000 AS VARCHAR) AS ns FROM events")
def epoch_nanos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(spark, sf_dir).select("event_id", times.epoch_nanos(F.col("ts")).alias("ns"))


@query(
    "ingest_lag",
    f"SELECT event_id, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(ts)) / 1e6 AS lag_seconds FROM events",
)
def ingest_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lag = times.seconds_between(times.instant(NOW), F.col("ts"))
    return raw_events(spark, sf_dir).select("event_id", lag.alias("lag_seconds"))


@query(
    "safe_int",
    f"""WITH {E_SQL} SELECT event_id,
      coalesce(CAST(trunc(try_cast(f_DB_TOTAL_TIME || '.7' AS DOUBLE)) AS BIGINT), 0) AS number FROM e""",
)
def safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.concat(map_field()("DB_TOTAL_TIME"), F.lit(".7"))
    return entries(spark, sf_dir).select("event_id", text.safe_int(value).alias("number"))


@query(
    "position_codec",
    """SELECT event_id, base64(encode(printf('%016x', event_id))) AS token,
      lower(hex(encode(printf('%016x', event_id)))) AS sample_key,
      printf('%016x', event_id) AS position FROM events""",
)
def position_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    position = F.format_string("%016x", "event_id").cast("binary")
    token = text.position_text(position)
    return raw_events(spark, sf_dir).select(
        "event_id",
        token.alias("token"),
        topic_sample_key(position).alias("sample_key"),
        text.position_bytes(token).cast("string").alias("position"),
    )


# --- sampling and filters -----------------------------------------------------------------------


@query(
    "sample_rows",
    f"""SELECT event_id, bucket FROM (SELECT event_id,
      {BUCKET_SQL.format("CAST(event_id AS VARCHAR)")} AS bucket FROM events) WHERE bucket < 2500""",
)
def sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id").cast("string")
    return sample_rows(raw_events(spark, sf_dir), key, 0.25).select(
        "event_id", identity.sample_bucket(key).alias("bucket")
    )


@query(
    "sample_key_choice",
    f"""WITH {E_SQL}, keyed AS (SELECT event_id, CASE source
        WHEN 'eventlogfile' THEN coalesce(nullif(f_REQUEST_ID, ''), line)
        WHEN 'pubsub' THEN lower(hex(encode(CAST(event_id AS VARCHAR))))
        ELSE line END AS key FROM e)
      SELECT event_id, {BUCKET_SQL.format("key")} AS bucket FROM keyed""",
)
def sample_key_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.col("payload")
    key = (
        F.when(F.col("source") == "eventlogfile", file_sample_key(payload))
        .when(F.col("source") == "pubsub", topic_sample_key(F.col("event_id").cast("string").cast("binary")))
        .otherwise(object_sample_key(payload))
    )
    return filled_entries(spark, sf_dir).select("event_id", identity.sample_bucket(key).alias("bucket"))


@query(
    "sample_rate_by_glob",
    f"""WITH {E_SQL}, rated AS (SELECT event_id, event_type, CASE WHEN event_type LIKE 'Login%' THEN 0.5
        WHEN event_type LIKE 'Api%e' THEN 0.1 ELSE 1.0 END::DOUBLE AS rate,
        {BUCKET_SQL.format("CAST(event_id AS VARCHAR)")} AS bucket FROM e)
      SELECT event_type, rate, count(*) AS kept FROM rated
      WHERE rate >= 1 OR bucket < rate * 10000 GROUP BY ALL""",
)
def sample_rate_by_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = entries(spark, sf_dir).withColumn(
        "rate", rate_by_glob(F.col("event_type"), [("Login*", 0.5), ("Api*e", 0.1), ("*Stream", 0.9)])
    )
    kept = sample_rows(rated, F.col("event_id").cast("string"), F.col("rate"))
    return kept.groupBy("event_type", "rate").agg(F.count("*").alias("kept"))


@query(
    "time_range_filter",
    """SELECT event_id, ts FROM events
      WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'""",
)
def time_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_range(table(spark, sf_dir, "events").select("event_id", "ts"), "2024-01-05", "2024-01-12")


@query(
    "selector_and_field_filter",
    f"""WITH {E_SQL} SELECT event_id, f_CLIENT_IP AS client_ip FROM e
      WHERE source = 'eventlogfile' AND event_type = 'ApexCallout' AND f_SUCCESS = '0'
      AND f_CLIENT_IP <> '' AND f_COUNTRY <> 'US'""",
)
def selector_and_field_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    def field(name: str) -> Column:
        return F.coalesce(map_field()(name), F.lit(""))

    rows = entries(spark, sf_dir).filter(
        (F.col("source") == "eventlogfile") & (F.col("event_type") == "ApexCallout")
    )
    rows = rows.filter(
        (field("SUCCESS") == "0") & (field("CLIENT_IP") != "") & (field("COUNTRY") != "US")
    )
    return rows.select("event_id", field("CLIENT_IP").alias("client_ip"))


@query(
    "glob_filter",
    f"""WITH {E_SQL} SELECT event_id FROM e
      WHERE regexp_full_match(f_CLIENT_IP, '10\\.[0-3]\\..*\\.[^5]') """,
)
def glob_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(spark, sf_dir).filter(
        globs.matches_glob(map_field()("CLIENT_IP"), "10.[0-3].*.[!5]")
    ).select("event_id")
