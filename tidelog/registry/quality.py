"""Quality reports (DQ) and audits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.labels import merge_maps, text_map
from tidelog.functions.text import line_bytes
from tidelog.operators.shape import cap_entries
from tidelog.plans import quality
from tidelog.registry.base import query
from tidelog.registry.joins import LIMITS_SQL, limit_snapshots
from tidelog.registry.shape import shaped
from tidelog.registry.tables import E_SQL, FILES_SQL, entries, files, raw_events, table
from tidelog.sinks.entries import reject_counts, reject_reason, split_rejects
from tidelog.sources.orgs import load_limits


@query(
    "entitlement_gaps",
    f"""WITH {FILES_SQL}, {E_SQL} SELECT DISTINCT event_type AS name FROM e
      WHERE event_type NOT IN (SELECT "EventType" FROM files WHERE "EventType" IS NOT NULL)""",
)
def entitlement_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    configured = entries(spark, sf_dir).select(F.col("event_type").alias("name"))
    return quality.entitlement_gaps(configured, files(spark, sf_dir))


@query(
    "limit_headroom",
    f"""WITH {LIMITS_SQL} SELECT user_id, name, remaining / max AS share,
      CASE WHEN remaining / max < 0.2 THEN 'WARN' ELSE 'PASS' END AS status FROM limits""",
)
def limit_headroom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.limit_headroom(load_limits(limit_snapshots(spark, sf_dir)), ["user_id", "name"])


@query(
    "fallback_rate",
    f"WITH {E_SQL} SELECT source, avg(CASE WHEN k % 13 IN (0, 2) THEN 1.0::DOUBLE ELSE 0 END) AS fallback_rate FROM e GROUP BY 1",
)
def fallback_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fallback_rate(shaped(spark, sf_dir))


@query(
    "truncation_report",
    """SELECT source, count(*) FILTER (b > 2000) AS truncated,
      CAST(sum(CASE WHEN b > 2000 THEN b - kept ELSE 0 END) AS BIGINT) AS bytes_lost FROM (
        SELECT source, octet_length(encode(text)) AS b, octet_length(encode('…[truncated, original ' || octet_length(encode(text)) || ' bytes]'))
          + list_max([n FOR n IN list_prefix IF n <= 2000 - octet_length(encode('…[truncated, original ' || octet_length(encode(text)) || ' bytes]'))]) AS kept
        FROM (SELECT source, text, list_transform(range(1, 2001), lambda n: octet_length(encode(left(text, CAST(n AS INT))))) AS list_prefix FROM documents))
      GROUP BY 1""",
)
def truncation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", F.col("text").alias("line"))
    return quality.truncation_report(cap_entries(docs, 2000))


@query(
    "overlap_report",
    f"""WITH {E_SQL}, names AS (SELECT DISTINCT source, event_type AS name FROM e
        UNION SELECT DISTINCT 'pubsub', '/event/' || event_type || 'EventStream' FROM e WHERE source = 'eventlogfile' AND k < 50 AND event_type = 'ApexCallout'
        UNION SELECT 'eventlogfile', 'API' FROM e),
      cats AS (SELECT *, CASE WHEN source = 'eventlogfile' THEN replace(lower(name), ' ', '')
        ELSE lower(regexp_replace(regexp_extract(name, '[^/]*$'), '(.)(EventStream|EventStore|Event)$', '\\1')) END AS category FROM names)
      SELECT category, count(DISTINCT source) OVER (PARTITION BY category) AS sources, source, name FROM cats
      QUALIFY sources > 1""",
)
def overlap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = entries(spark, sf_dir)
    own = rows.select("source", F.col("event_type").alias("name"))
    extra = rows.filter("event_type = 'ApexCallout' AND k < 50").select(
        F.lit("pubsub").alias("source"), F.concat(F.lit("/event/"), "event_type", F.lit("EventStream")).alias("name")
    )
    listed = rows.select(F.lit("eventlogfile").alias("source"), F.lit("API").alias("name"))
    return quality.overlap_report(own.unionByName(extra).unionByName(listed))


@query(
    "preferred_sources",
    f"""WITH {E_SQL}, cats AS (SELECT DISTINCT source, CASE WHEN source = 'eventlogfile' THEN replace(lower(event_type), ' ', '')
        ELSE lower(regexp_replace(event_type, '(.)(EventStream|EventStore|Event)$', '\\1')) END AS category,
        CASE source WHEN 'pubsub' THEN 1 WHEN 'eventlog_objects' THEN 2 ELSE 3 END AS rank FROM e),
      best AS (SELECT category, arg_min(source, rank) AS preferred FROM cats GROUP BY 1)
      SELECT category, preferred, source FROM cats JOIN best USING (category) WHERE source <> preferred""",
)
def preferred_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = entries(spark, sf_dir).select("source", F.col("event_type").alias("name"))
    return quality.preferred_sources(names)


@query(
    "double_count_audit",
    f"""WITH {E_SQL} SELECT 'login' AS category, source, count(*) AS rows FROM e
      WHERE event_type IN ('Login', 'LoginEventStream') GROUP BY 2""",
)
def double_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.double_count_audit(entries(spark, sf_dir))


@query(
    "label_audit",
    f"""WITH {E_SQL} SELECT 'COUNTRY' AS label, count(*) AS rows, count(DISTINCT source || '|' || event_type || '|' || f_COUNTRY || '|' || coalesce(f_API_FAMILY, '-')) AS streams FROM e
      UNION ALL SELECT 'api_family', count(*), count(DISTINCT f_COUNTRY || '|' || f_API_FAMILY) FROM e WHERE f_API_FAMILY IS NOT NULL""",
)
def label_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shaped(spark, sf_dir)
    extra = text_map({"api_family": F.col("payload").getItem("API_FAMILY")})
    return quality.label_audit(rows.withColumn("labels", merge_maps(F.col("labels"), extra)))


_REASON = """CASE WHEN k = 5 THEN 'no_time' WHEN k = 6 THEN 'no_line' WHEN octet_length(encode(line)) > 285 THEN 'oversized'
  WHEN k = 8 THEN 'bad_label' END"""


def _deliverable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shaped(spark, sf_dir)
    k = F.col("k")
    bad = text_map({"team": F.when(k == 8, F.lit("x"))})
    allowed = F.map_filter("labels", lambda name, _: name != "COUNTRY")
    return rows.withColumns(
        {
            "ts": F.when(k != 5, F.col("ts")),
            "line": F.when(k != 6, F.col("line")),
            "labels": merge_maps(allowed, bad),
        }
    )


@query(
    "split_rejects",
    f"WITH {E_SQL} SELECT event_id, {_REASON} AS reject_reason FROM e WHERE {_REASON} IS NOT NULL",
)
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_rejects(_deliverable(spark, sf_dir), reject_reason(285))
    return bad.select("event_id", "reject_reason")


@query(
    "reject_counts",
    f"WITH {E_SQL} SELECT {_REASON} AS reject_reason, count(*) AS n FROM e WHERE {_REASON} IS NOT NULL GROUP BY 1",
)
def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(_deliverable(spark, sf_dir), reject_reason(285))


@query(
    "backfill_warnings",
    """WITH a AS (SELECT epoch_us(TIMESTAMP '2024-02-05') - epoch_us(min(ts)) AS age FROM events),
      d AS (SELECT age, CAST(floor(age / 86400e6) AS BIGINT) AS days FROM a)
      SELECT 'retention' AS finding, 'starts ' || days || ' days ago; files are kept 30 days' AS detail FROM d WHERE age > 30 * 86400e6
      UNION ALL SELECT 'old_samples', 'starts ' || days || ' days ago; true times older than 7 days may be refused, use ingest times'
      FROM d WHERE age > 7 * 86400e6""",
)
def backfill_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings on a backfill that starts with the first event."""
    since = raw_events(spark, sf_dir).agg(F.min("ts").cast("timestamp_ntz")).first()[0]
    return quality.backfill_warnings(spark, since, datetime(2024, 2, 5))


@query(
    "stored_bytes_by_type",
    f"WITH {E_SQL} SELECT event_type, CAST(sum(octet_length(encode(line))) AS BIGINT) AS bytes FROM e GROUP BY 1",
)
def stored_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(spark, sf_dir).groupBy("event_type").agg(F.sum(line_bytes(F.col("line"))).alias("bytes"))
