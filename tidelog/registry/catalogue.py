"""File catalogue, discovery and gates (SRC-2..6, SRC-8..10, SRC-18, SRT-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.dedup import latest_by_id
from tidelog.plans.quality import categorised
from tidelog.registry.base import query
from tidelog.registry.tables import E_SQL, FILES_SQL, entries, files, table
from tidelog.sources import catalogue as cat

NOW = "2001-08-02 00:00:00"
_NAMES = "'https://' || c_mktsegment || '/' || c_name"


@query(
    "select_files",
    f"""WITH {FILES_SQL} SELECT "Id", created, version,
      coalesce(CAST(trunc(try_cast("LogFileLength" AS DOUBLE)) AS BIGINT), 0) AS length,
      coalesce(CAST("Sequence" AS BIGINT), 0) AS sequence FROM files
      WHERE "EventType" = 'Login' AND "Interval" = 'Hourly' AND created >= TIMESTAMP '1996-01-01'""",
)
def select_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cat.select_files(files(spark, sf_dir), "Login", "Hourly", "1996-01-01")
    return found.select("Id", "created", "version", "length", "sequence")


@query(
    "discover_types",
    f"""WITH {FILES_SQL} SELECT DISTINCT "EventType" FROM files
      WHERE "Interval" = 'Hourly' AND "EventType" IS NOT NULL""",
)
def discover_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.discover_types(files(spark, sf_dir), "Hourly")


@query(
    "resolve_types",
    f"""WITH {FILES_SQL}, found AS (SELECT DISTINCT "EventType" AS name FROM files
        WHERE "Interval" = 'Hourly' AND "EventType" IS NOT NULL)
      SELECT 'Login' AS name, 1.0::DOUBLE AS sample, true AS explicit
      UNION ALL SELECT name, 0.25, false FROM found
      WHERE name NOT IN ('Login', 'Report') AND replace(lower(name), ' ', '') <> 'api'""",
)
def resolve_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`Login` is listed, `Report` excluded, and the category `api` is owned by a stream."""
    configured = spark.createDataFrame([("Login", 1.0), ("*", 0.25)], "name string, sample double")
    excluded = spark.createDataFrame([("Report",)], "name string")
    owned = (
        entries(spark, sf_dir)
        .filter(F.col("source") != "eventlogfile")
        .select("source", F.col("event_type").alias("name"))
        .distinct()
    )
    discovered = cat.discover_types(files(spark, sf_dir), "Hourly")
    owned = categorised(owned).filter("category <> 'login'")
    return cat.resolve_types(configured, discovered, excluded, owned)


@query(
    "select_by_glob",
    f"""SELECT DISTINCT {_NAMES} AS name FROM customer
      WHERE (c_mktsegment LIKE 'B%' OR regexp_matches(c_name, '[02468]$'))
      AND NOT regexp_matches(c_name, '00[0-4].$')""",
)
def select_by_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("https://"), "c_mktsegment", F.lit("/"), "c_name").alias("name")
    )
    twice = names.unionByName(names).unionByName(spark.createDataFrame([("*",)], "name string"))
    return cat.select_by_glob(twice, ["https://B*", "*[02468]"], ["*00[0-4]?"])


@query(
    "discover_stream_topics",
    f"WITH {E_SQL} SELECT DISTINCT '/event/' || event_type AS topic FROM e WHERE event_type LIKE '%EventStream'",
)
def stream_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = entries(spark, sf_dir).select(F.col("event_type").alias("name")).distinct()
    return cat.discover_stream_topics(names)


@query(
    "latest_files",
    f"""WITH {FILES_SQL} SELECT "Id", created, version FROM files
      QUALIFY row_number() OVER (PARTITION BY "Id" ORDER BY created DESC) = 1""",
)
def latest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = cat.with_created(files(spark, sf_dir)).select("Id", "created", "version")
    return cat.latest_files(versions)


@query(
    "latest_version_per_user",
    """SELECT user_id, event_id, event_type FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return latest_by_id(rows, "user_id", ["ts", "event_id"]).drop("ts")


_DONE = """done AS (SELECT "Id", created FROM files WHERE version = 0 AND o_orderstatus = 'F'
  UNION ALL SELECT "Id", NULL FROM files WHERE version = 0 AND o_orderstatus = 'P' AND o_custkey % 2 = 0)"""


@query(
    "unprocessed_files",
    f"""WITH {FILES_SQL}, {_DONE}, latest AS (SELECT "Id", created, version FROM files
        QUALIFY row_number() OVER (PARTITION BY "Id" ORDER BY created DESC) = 1)
      SELECT "Id", created, version FROM latest f WHERE NOT EXISTS (SELECT 1 FROM done d
        WHERE d."Id" = f."Id" AND (d.created IS NULL OR d.created >= f.created))""",
)
def unprocessed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regenerated file is read again; an entry without a version matches any."""
    versions = cat.with_created(files(spark, sf_dir))
    first = versions.filter("version = 0")
    done = first.filter("o_orderstatus = 'F'").select("Id", "created").unionByName(
        first.filter("o_orderstatus = 'P' AND o_custkey % 2 = 0").select(
            "Id", F.lit(None).cast("timestamp").alias("created")
        )
    )
    return cat.unprocessed_files(versions.select("Id", "created", "version"), done)


@query(
    "settled_only",
    f"""WITH {FILES_SQL} SELECT "Id", version FROM files
      WHERE created <= TIMESTAMP '{NOW}' - INTERVAL 36 HOUR""",
)
def settled_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = cat.with_created(files(spark, sf_dir))
    return cat.settled_only(versions, NOW, window_minutes=36 * 60).select("Id", "version")


_MAX_AGE_HOURS = 24 * 400


@query(
    "split_unreadable",
    f"""WITH {FILES_SQL}, marked AS (SELECT *, o_orderstatus = 'P' AND o_custkey % 100 = 7 AS failed FROM files
        WHERE "EventType" IS NOT NULL),
      holds AS (SELECT "EventType", min({{'c': created, 'i': "Id"}}) AS hold FROM marked
        WHERE failed AND created >= TIMESTAMP '{NOW}' - INTERVAL {_MAX_AGE_HOURS} HOUR GROUP BY 1)
      SELECT "Id", version, CASE WHEN hold IS NOT NULL AND {{'c': created, 'i': "Id"}} >= hold THEN 'held'
        WHEN failed THEN 'abandoned' ELSE 'read' END AS state
      FROM marked LEFT JOIN holds USING ("EventType")""",
)
def split_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = cat.with_created(files(spark, sf_dir).filter("EventType IS NOT NULL"))
    marked = versions.withColumn("failed", F.expr("o_orderstatus = 'P' AND o_custkey % 100 = 7"))
    return cat.split_unreadable(marked, NOW, _MAX_AGE_HOURS).select("Id", "version", "state")


@query(
    "backfill_files",
    f"""WITH {FILES_SQL} SELECT "Id", created FROM files f WHERE "Interval" = 'Daily'
      AND "EventType" IN ('Login', 'API') AND created >= TIMESTAMP '1997-01-01'
      AND created < TIMESTAMP '1998-01-01' AND NOT EXISTS
        (SELECT 1 FROM files d WHERE d."Id" = f."Id" AND d.o_orderstatus = 'F')""",
)
def backfill_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = files(spark, sf_dir)
    done = listed.filter("o_orderstatus = 'F'").select("Id")
    found = cat.backfill_files(listed, "1997-01-01", "1998-01-01", ["Login", "API"], "Daily", done)
    return found.select("Id", "created")


@query(
    "composite_order",
    f"""WITH {FILES_SQL}, dated AS (SELECT "Id", version, CASE WHEN o_custkey % 50 <> 0 THEN created END AS created FROM files)
      SELECT "Id", version, row_number() OVER (ORDER BY created NULLS FIRST, "Id", version) - 1 AS place FROM dated""",
)
def composite_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every file in reading order; unparseable dates come first."""
    listed = files(spark, sf_dir)
    broken = F.when(F.col("o_custkey") % 50 != 0, F.col("CreatedDate")).otherwise("unknown")
    dated = cat.with_created(listed.withColumn("CreatedDate", broken)).select("Id", "version", "created")
    return cat.reading_places(dated, ["version"]).select("Id", "version", "place")
