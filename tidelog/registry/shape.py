"""Projections (PRJ): payload to entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.identity import topic_event_type
from tidelog.functions.labels import (
    disallowed_labels,
    promote,
    render_labels,
    static_labels,
    stream_key,
    text_map,
)
from tidelog.functions.payload import canonical_json, canonical_line
from tidelog.operators.shape import (
    backfill_marks,
    debug_log_metadata,
    entry_labels,
    promote_by_type,
    promote_metadata,
    shape_entries,
    with_type_fields,
)
from tidelog.operators.streaks import ingest_clock
from tidelog.registry.base import query
from tidelog.registry.scalars import _FALLBACK_SQL, LEVEL_SQL, NOW, PARSED_SQL
from tidelog.registry.tables import E_SQL, entries, filled_entries, raw_events

STATIC = static_labels(
    "audit", environment="prod", org_id="00D1", operator_labels={"service_name": "crm"}
)
METADATA = ["USER_ID", "REQUEST_ID", "LOGIN_STATUS"]


def _json(fields: list[tuple[str, str]]) -> str:
    """SQL text of a JSON object with the given keys (already ascending); null values left out."""
    parts = ", ".join(f"'\"{k}\":\"' || replace({v}, '\"', '\\\"') || '\"'" for k, v in fields)
    return f"'{{' || array_to_string(list_filter([{parts}], lambda x: x IS NOT NULL), ',') || '}}'"


_METADATA_SQL = _json(
    [("LOGIN_STATUS", "f_LOGIN_STATUS"), ("REQUEST_ID", "f_REQUEST_ID"), ("USER_ID", "f_USER_ID"),
     ("level", LEVEL_SQL)]
)
_LABELS_SQL = _json(
    [("COUNTRY", "f_COUNTRY"), ("environment", "'prod'"), ("event_type", "event_type"),
     ("job", "'audit'"), ("service_name", "'crm'"), ("sf_org_id", "'00D1'"), ("source", "source")]
)


@query("canonical_line", f"WITH {E_SQL} SELECT event_id, line FROM e")
def canonical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled_entries(spark, sf_dir).select(
        "event_id", canonical_line(F.col("payload")).alias("line")
    )


@query(
    "canonical_json",
    """SELECT event_id, '{"a":{"x":' || json_extract_string(props, '$.k') || ',"y":null},"id":' || event_id
      || ',"type":"' || event_type || '"}' AS line FROM events""",
)
def canonical_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested JSON text gets ascending keys at every level and no blanks; nulls stay."""
    messy = F.concat(
        F.lit('{"type": "'), "event_type", F.lit('", "id": '), F.col("event_id").cast("string"),
        F.lit(', "a": {"y": null, "x": '), F.get_json_object("props", "$.k"), F.lit("}}"),
    )
    return raw_events(spark, sf_dir).select("event_id", canonical_json(messy).alias("line"))


@query("promote_metadata", f"WITH {E_SQL} SELECT event_id, {_METADATA_SQL} AS metadata FROM e")
def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(spark, sf_dir).select(
        "event_id", stream_key(promote_metadata(F.col("payload"), METADATA)).alias("metadata")
    )


@query(
    "promote_labels",
    f"WITH {E_SQL} SELECT event_id, {_json([('API_FAMILY', 'f_API_FAMILY'), ('COUNTRY', 'f_COUNTRY')])} AS labels FROM e",
)
def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(spark, sf_dir).select(
        "event_id", stream_key(promote(F.col("payload"), ["COUNTRY", "API_FAMILY", "NONE"])).alias("labels")
    )


@query(
    "type_overrides",
    f"""WITH {E_SQL} SELECT event_id, CASE event_type
        WHEN 'Login' THEN {_json([('level', LEVEL_SQL)])}
        WHEN 'ApexCallout' THEN {_json([('SUCCESS', 'f_SUCCESS'), ('TIME', 'f_TIME'), ('level', LEVEL_SQL)])}
        ELSE {_METADATA_SQL} END AS metadata,
      CASE event_type WHEN 'ApexCallout' THEN '{{}}' WHEN 'Login' THEN {_json([('COUNTRY', 'f_COUNTRY')])}
        ELSE '{{}}' END AS labels FROM e""",
)
def type_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Login promotes nothing but a label, ApexCallout its own list, all others the global one."""
    overrides = spark.createDataFrame(
        [("Login", [], ["COUNTRY"]), ("ApexCallout", ["TIME", "SUCCESS"], None), ("ApiEvent", None, [])],
        "event_type string, metadata_fields array<string>, label_fields array<string>",
    )
    shaped = promote_by_type(with_type_fields(entries(spark, sf_dir), overrides, METADATA))
    return shaped.select(
        "event_id", stream_key(F.col("metadata")).alias("metadata"), stream_key(F.col("promoted")).alias("labels")
    )


@query(
    "label_precedence",
    f"WITH {E_SQL} SELECT event_id, {_LABELS_SQL} AS labels FROM e",
)
def label_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A promoted field cannot pose as the source; static labels win over all."""
    promoted = text_map(
        {"COUNTRY": F.col("payload").getItem("COUNTRY"), "source": F.lit("forged"), "job": F.lit("forged")}
    )
    built = entry_labels(promoted, F.col("source"), F.col("event_type"), STATIC)
    return entries(spark, sf_dir).select("event_id", stream_key(built).alias("labels"))


@query(
    "static_labels",
    f"""WITH {E_SQL} SELECT source, event_type, org, count(*) AS n,
      '{{environment="prod",event_type="' || event_type || '",job="audit",service_name="crm",sf_org_id="00D1",source="'
      || source || '"}}' AS single_org,
      '{{event_type="' || event_type || '",job="audit",service_name="audit",source="' || source || '"}}' AS multi_org
      FROM e GROUP BY ALL""",
)
def static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With several orgs, environment and org id are not static."""
    groups = entries(spark, sf_dir).groupBy("source", "event_type", "org").agg(F.count("*").alias("n"))
    none = text_map({})
    single = entry_labels(none, F.col("source"), F.col("event_type"), STATIC)
    multi = entry_labels(none, F.col("source"), F.col("event_type"), static_labels("audit"))
    return groups.withColumns({"single_org": render_labels(single), "multi_org": render_labels(multi)})


@query(
    "render_labels",
    """SELECT doc_id, '{source="' || source || '",text="' || replace(replace(replace(text, '\\', '\\\\'),
      '"', '\\"'), chr(10), '\\n') || '"}' AS rendered FROM documents""",
)
def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(
        "doc_id", render_labels(text_map({"text": F.col("text"), "source": F.col("source")})).alias("rendered")
    )


@query(
    "disallowed_labels",
    f"""WITH {E_SQL} SELECT event_id, CASE WHEN f_API_FAMILY IS NOT NULL THEN 'API_FAMILY,COUNTRY'
      ELSE 'COUNTRY' END AS bad FROM e""",
)
def disallowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    promoted = promote(F.col("payload"), ["COUNTRY", "API_FAMILY"])
    built = entry_labels(promoted, F.col("source"), F.col("event_type"), STATIC)
    return entries(spark, sf_dir).select(
        "event_id", F.array_join(disallowed_labels(built), ",").alias("bad")
    )


@query(
    "debug_log_metadata",
    """SELECT conv_id, turn, '{"Id":"' || conv_id || '-' || turn || '",' ||
      CASE WHEN role = 'user' THEN '"Status":"promoted"' ELSE '"Operation":"' || role || '","Status":"Success"' END
      || '}' AS metadata FROM conversations""",
)
def debug_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty fields are left out, promoted ones are not replaced."""
    user = F.col("role") == "user"
    fields = {
        "Id": F.concat_ws("-", "conv_id", "turn"),
        "Operation": F.when(user, F.lit("")).otherwise(F.col("role")),
        "Status": F.lit("Success"),
        "Location": F.lit(None).cast("string"),
    }
    promoted = text_map({"Status": F.when(user, F.lit("promoted"))})
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.select(
        "conv_id", "turn", stream_key(debug_log_metadata(fields, promoted)).alias("metadata")
    )


_SHAPED_SQL = f"""shaped AS (SELECT event_id, source, event_type, ts AS arrived,
  coalesce({PARSED_SQL}, {_FALLBACK_SQL}) AS ts, {PARSED_SQL} IS NULL AS used_fallback, line,
  {_LABELS_SQL} AS labels, {_METADATA_SQL} AS metadata FROM e)"""


def shaped(spark: SparkSession, sf_dir: str, max_line_bytes: int = 262_144) -> DataFrame:
    """Entries of the event table, as a file source would shape them."""
    rows = filled_entries(spark, sf_dir).withColumnRenamed("ts", "arrived")
    return shape_entries(
        rows,
        now=NOW,
        time_fields=["TIMESTAMP_DERIVED"],
        metadata_fields=METADATA,
        label_fields=["COUNTRY"],
        static=STATIC,
        fallback=F.col("arrived"),
        max_line_bytes=max_line_bytes,
    )


@query(
    "shape_entries",
    f"WITH {E_SQL}, {_SHAPED_SQL} SELECT event_id, ts, used_fallback, line, labels, metadata FROM shaped",
)
def shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(spark, sf_dir).select(
        "event_id", "ts", "used_fallback", "line",
        stream_key(F.col("labels")).alias("labels"), stream_key(F.col("metadata")).alias("metadata"),
    )


@query(
    "backfill_label_mode",
    f"""WITH {E_SQL}, {_SHAPED_SQL} SELECT event_id, ts,
      replace(labels, '"environment"', '"backfill":"true","environment"') AS labels FROM shaped""",
)
def backfill_label_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill_marks(shaped(spark, sf_dir)).select(
        "event_id", "ts", stream_key(F.col("labels")).alias("labels")
    )


@query(
    "backfill_ingest_mode",
    f"""WITH {E_SQL}, {_SHAPED_SQL} SELECT event_id,
      TIMESTAMP '{NOW}' + to_microseconds(row_number() OVER (ORDER BY source, event_type, event_id) - 1) AS ts,
      strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time FROM shaped""",
)
def backfill_ingest_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One microsecond per row in file and row order; the true time goes to the metadata."""
    rows = shaped(spark, sf_dir).select("event_id", "source", "event_type", "ts", "metadata")
    clocked = ingest_clock(rows, ["source", "event_type", "event_id"], NOW)
    return backfill_marks(clocked, "ingest_ts").select(
        "event_id", "ts", F.col("metadata").getItem("event_time").alias("event_time")
    )


@query(
    "topic_event_type",
    f"WITH {E_SQL} SELECT event_id, event_type AS name FROM e",
)
def topic_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = F.concat(F.lit("/event/"), "event_type", F.when(F.col("k") % 2 == 0, "//").otherwise(""))
    return entries(spark, sf_dir).select("event_id", topic_event_type(topic).alias("name"))
