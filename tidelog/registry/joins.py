"""Joins, sets, sources of several kinds (JOIN, SET, SRC-16, SRC-17, SRC-19, SRC-20)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.labels import stream_key, text_map
from tidelog.operators.correlate import correlate_requests
from tidelog.operators.dedup import (
    dedup_entries,
    difference,
    first_by_id,
    not_owned,
    not_processed,
)
from tidelog.operators.series import vector_ratio
from tidelog.operators.shape import with_type_fields
from tidelog.plans.alerting import headroom
from tidelog.plans.quality import categorised
from tidelog.registry.base import query
from tidelog.registry.shape import shaped
from tidelog.registry.tables import E_SQL, FILES_SQL, entries, files, raw_events, table
from tidelog.sources.debug_logs import logs_of_users, logs_with_bodies, read_debug_logs
from tidelog.sources.orgs import Org, load_limits, union_orgs

NOW = "2024-02-01 00:00:00"


@query(
    "not_processed",
    """SELECT event_id, user_id FROM events e WHERE NOT EXISTS
      (SELECT 1 FROM orders o WHERE o.o_orderkey = e.event_id AND o.o_custkey % 150 = e.user_id % 150)""",
)
def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anti-join on id and version."""
    rows = table(spark, sf_dir, "events").withColumn("version", F.col("user_id") % 150)
    done = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_id"), (F.col("o_custkey") % 150).alias("version")
    )
    return not_processed(rows, done, ["event_id", "version"]).select("event_id", "user_id")


@query(
    "not_owned",
    f"""WITH {FILES_SQL}, {E_SQL} SELECT DISTINCT "EventType" AS name,
      replace(lower("EventType"), ' ', '') AS category FROM files WHERE "EventType" IS NOT NULL
      AND replace(lower("EventType"), ' ', '') NOT IN (SELECT lower(regexp_replace(event_type,
        '(EventStream|Event)$', '')) FROM e WHERE source <> 'eventlogfile')""",
)
def owned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File types whose category neither the stream nor the stored objects feed."""
    names = files(spark, sf_dir).filter("EventType IS NOT NULL").select(F.col("EventType").alias("name")).distinct()
    feeds = (
        entries(spark, sf_dir)
        .filter("source <> 'eventlogfile'")
        .select("source", F.col("event_type").alias("name"))
        .distinct()
    )
    return not_owned(names, categorised(feeds), "eventlogfile").select("name", "category")


@query(
    "type_config_lookup",
    f"""WITH {E_SQL} SELECT event_id, CASE event_type WHEN 'Login' THEN '' WHEN 'ApiEvent' THEN 'STATUS_CODE'
      ELSE 'USER_ID,COUNTRY' END AS fields FROM e""",
)
def type_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    overrides = spark.createDataFrame(
        [("Login", [], None), ("ApiEvent", ["STATUS_CODE"], None), ("ApexCallout", None, None)],
        "event_type string, metadata_fields array<string>, label_fields array<string>",
    )
    rows = with_type_fields(entries(spark, sf_dir), overrides, ["USER_ID", "COUNTRY"])
    return rows.select("event_id", F.array_join("metadata_fields", ",").alias("fields"))


@query(
    "vector_ratio",
    """SELECT o_custkey AS series, a.value / b.value AS ratio
      FROM (SELECT o_custkey, count(*) AS value FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a
      JOIN (SELECT o_custkey, max(o_orderkey) AS value FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) b
      USING (o_custkey)""",
)
def ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "series")
    left = orders.filter("o_orderstatus = 'F'").groupBy("series").agg(F.count("*").alias("value"))
    right = orders.filter("o_orderstatus = 'P'").groupBy("series").agg(F.max("o_orderkey").alias("value"))
    return vector_ratio(left, right, ["series"])


@query(
    "correlate_requests",
    f"""WITH {E_SQL}, bodies AS (SELECT doc_id, text || ' req-' || (doc_id * 7 % 5000) || '; again req-' ||
        (doc_id * 7 % 5000) || ' and req-' || (doc_id % 40) AS body FROM documents),
      named AS (SELECT DISTINCT doc_id AS log_id, unnest(regexp_extract_all(body, 'req-[0-9]+')) AS request_id FROM bodies),
      known AS (SELECT f_REQUEST_ID AS request_id, count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts
        FROM e WHERE f_REQUEST_ID <> '' GROUP BY 1)
      SELECT log_id, request_id, rows, first_ts, last_ts FROM named JOIN known USING (request_id)""",
)
def correlated(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    body = F.concat_ws(
        "", "text", F.lit(" req-"), doc * 7 % 5000, F.lit("; again req-"), doc * 7 % 5000, F.lit(" and req-"), doc % 40
    )
    bodies = table(spark, sf_dir, "documents").select(doc.alias("log_id"), body.alias("body"))
    rows = entries(spark, sf_dir).withColumn("request", F.col("payload").getItem("REQUEST_ID"))
    return correlate_requests(bodies, rows, "req-[0-9]+", "log_id", "body", "request", "ts")


_META_SQL = """meta AS (SELECT conv_id, turn, role, text, conv_id || '-' || turn AS "Id",
  octet_length(encode(text)) AS "LogLength", conv_id % 7 = 3 AS lost FROM conversations)"""


def _debug_logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    turns = table(spark, sf_dir, "conversations").withColumn("Id", F.concat_ws("-", "conv_id", "turn"))
    minute = F.expr("make_interval(0, 0, 0, 0, 0, CAST(turn AS INT))")
    meta = turns.select(
        "Id",
        F.col("role").alias("Username"),
        F.octet_length("text").cast("bigint").alias("LogLength"),
        F.col("role").alias("Operation"),
        F.date_format(F.lit("2024-01-31 10:00:00").cast("timestamp") + minute, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("StartTime"),
    )
    return meta, turns.filter("conv_id % 7 <> 3").select("Id", F.col("text").alias("body"))


@query(
    "read_debug_logs",
    f"""WITH {_META_SQL} SELECT "Id" AS log_id, TIMESTAMP '2024-01-31 10:00:00' + to_minutes(turn) AS ts,
      CASE WHEN "LogLength" > 600 THEN 'size' WHEN lost THEN 'download_error' END AS skip_reason,
      CASE WHEN "LogLength" <= 600 AND NOT lost THEN text ELSE '{{"Id":"' || "Id" || '","LogLength":"' || "LogLength"
        || '","Operation":"' || role || '","StartTime":"' ||
        strftime(TIMESTAMP '2024-01-31 10:00:00' + to_minutes(turn), '%Y-%m-%dT%H:%M:%SZ') || '"}}' END AS line,
      CASE WHEN "LogLength" <= 600 AND NOT lost THEN NULL ELSE 'true' END AS body_skipped FROM meta""",
)
def debug_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta, bodies = _debug_logs(spark, sf_dir)
    return read_debug_logs(meta, bodies, 600, now=NOW).select(
        "log_id", "ts", "skip_reason", "line", F.col("metadata").getItem("body_skipped").alias("body_skipped")
    )


@query(
    "debug_log_users",
    f"""WITH {_META_SQL} SELECT role AS "Username", count(*) AS logs, CAST(sum("LogLength") AS BIGINT) AS bytes FROM meta
      WHERE role IN ('user', 'system') GROUP BY 1""",
)
def debug_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta, _ = _debug_logs(spark, sf_dir)
    return logs_of_users(meta, ["user", "system"]).groupBy("Username").agg(
        F.count("*").alias("logs"), F.sum("LogLength").alias("bytes")
    )


@query(
    "debug_log_bodies",
    f"""WITH {_META_SQL} SELECT "Id", "LogLength", CASE WHEN NOT lost AND "LogLength" <= 400 THEN length(text) END AS chars,
      CASE WHEN "LogLength" > 400 THEN 'size' WHEN lost THEN 'download_error' END AS skip_reason FROM meta""",
)
def debug_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every log with its body where there is one of an allowed size."""
    meta, bodies = _debug_logs(spark, sf_dir)
    return logs_with_bodies(meta, bodies, 400).select(
        "Id", "LogLength", F.length("body").cast("bigint").alias("chars"), "skip_reason"
    )


@query(
    "union_orgs",
    f"""WITH {E_SQL} SELECT event_id, 'org=' || org || ':' || source AS ckpt_key,
      '{{"environment":"' || CASE org WHEN 'org0' THEN 'prod' WHEN 'org1' THEN 'test' ELSE 'prod' END
      || '","org":"' || org || '"' || CASE org WHEN 'org1' THEN '' ELSE ',"sf_org_id":"00D' || org || '"' END
      || ',"source":"' || source || '"}}' AS labels FROM e""",
)
def orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three organisations; the id of the second is unknown."""
    rows = entries(spark, sf_dir).select(
        "event_id", "org", text_map({"source": F.col("source"), "environment": F.lit("none")}).alias("labels"),
        F.col("source").alias("ckpt_key"),
    )
    known = (Org("org0", "prod", "00Dorg0"), Org("org1", "test"), Org("org2", "prod", "00Dorg2"))
    merged = union_orgs({o: rows.filter(F.col("org") == o.name) for o in known})
    return merged.select("event_id", "ckpt_key", stream_key(F.col("labels")).alias("labels"))


def limit_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per user with two good limits, a malformed and an incomplete one."""
    number = F.col("max").cast("string")
    left = F.col("remaining").cast("string")
    doc = F.concat(
        F.lit('{"Daily": {"Max": '), number, F.lit(', "Remaining": '), left,
        F.lit('}, "Hourly": {"Max": "'), number, F.lit('.0", "Remaining": 1}, "Bad": {"Max": "x", "Remaining": 1}, "Half": {"Max": 5}}'),
    )
    users = raw_events(spark, sf_dir).groupBy("user_id").agg(
        F.count("*").alias("max"), F.count_if(F.col("k") < 15).alias("remaining")
    )
    return users.select("user_id", doc.alias("limits"))


LIMITS_SQL = """limits AS (SELECT user_id, 'Daily' AS name, count(*) AS max,
  count(*) FILTER (CAST(json_extract_string(props, '$.k') AS INT) < 15) AS remaining FROM events GROUP BY 1
  UNION ALL SELECT user_id, 'Hourly', count(*), 1 FROM events GROUP BY 1)"""


@query("load_limits", f"WITH {LIMITS_SQL} SELECT user_id, name, max, remaining FROM limits")
def limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_limits(limit_snapshots(spark, sf_dir))


@query(
    "limit_ratio",
    f"WITH {LIMITS_SQL} SELECT user_id, name, remaining / max AS ratio FROM limits",
)
def limit_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headroom(load_limits(limit_snapshots(spark, sf_dir)), ["user_id", "name"])


# --- sets ---------------------------------------------------------------------------------------


@query(
    "union_sources",
    """SELECT source, count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts FROM (
      SELECT 'events' AS source, ts FROM events UNION ALL SELECT 'orders', o_orderdate FROM orders
      UNION ALL SELECT 'lineitem', l_shipdate FROM lineitem) GROUP BY 1""",
)
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources feed one row type."""

    def rows(name: str, ts: str, line: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.lit(name).alias("source"), F.col(ts).cast("timestamp").alias("ts"), F.col(line).cast("string").alias("line")
        )

    merged = (
        rows("events", "ts", "props")
        .unionByName(rows("orders", "o_orderdate", "o_orderkey"))
        .unionByName(rows("lineitem", "l_shipdate", "l_orderkey"))
    )
    return merged.groupBy("source").agg(
        F.count("*").alias("rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query(
    "set_difference",
    """SELECT DISTINCT c_custkey AS id FROM customer WHERE c_custkey NOT IN
      (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""",
)
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    used = table(spark, sf_dir, "orders").filter("o_totalprice > 300000")
    return difference(wanted, used.select(F.col("o_custkey").alias("id")))


@query(
    "removed_topics",
    """SELECT DISTINCT user_id FROM events WHERE event_type = 'view'
      EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 200
      EXCEPT SELECT user_id FROM events WHERE event_type = 'click' AND value > 150""",
)
def removed_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscribed minus explicit minus discovered."""
    rows = table(spark, sf_dir, "events")

    def users(condition: str) -> DataFrame:
        return rows.filter(condition).select("user_id")

    return difference(
        users("event_type = 'view'"),
        users("event_type = 'purchase' AND value > 200"),
        users("event_type = 'click' AND value > 150"),
    )


@query(
    "dedup_entries",
    f"""WITH {E_SQL} SELECT event_id, ts, event_type FROM e""",
)
def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry was delivered once, those of one source twice, a third of all three times."""
    rows = shaped(spark, sf_dir).withColumn("ts", F.col("arrived")).select("event_id", "event_type", "ts", "labels", "line", "source", "k")
    again = rows.unionByName(rows.filter("source = 'eventlogfile'")).unionByName(rows.filter("k % 3 = 0"))
    return dedup_entries(again).select("event_id", "ts", "event_type")


@query(
    "dedup_same_line",
    """SELECT source, count(*) AS entries FROM (SELECT DISTINCT source, lang, text FROM documents) GROUP BY 1""",
)
def dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural copies: documents with the same labels and text at the same time are one entry."""
    docs = table(spark, sf_dir, "documents").select(
        F.lit(NOW).cast("timestamp").alias("ts"),
        text_map({"source": F.col("source"), "event_type": F.col("lang")}).alias("labels"),
        F.col("text").alias("line"),
        "source",
    )
    return dedup_entries(docs).groupBy("source").agg(F.count("*").alias("entries"))


@query(
    "first_by_id",
    """SELECT user_id, event_id, event_type, ts FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def first_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return first_by_id(rows, "user_id", ["ts", "event_id"])
