"""Redaction rules and row filters (RED, FLT-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.payload import canonical_line, map_field
from tidelog.operators.rules import (
    Rule,
    apply_rules,
    check_rules,
    hash_value,
    mask_value,
    redact_columns,
    unsalted_hash_audit,
)
from tidelog.registry.base import query
from tidelog.registry.tables import E_SQL, entries, filled_entries, table

SALT = "pepper"

_IPV4 = r"((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _mask(col: str) -> str:
    return (
        f"CASE WHEN contains({col}, '@') THEN '***@' || substr({col}, instr({col}, '@') + 1) "
        f"WHEN regexp_full_match({col}, '{_IPV4}') THEN regexp_replace({col}, '[0-9]+$', 'x') "
        f"WHEN {col} IS NOT NULL THEN '***' END"
    )


@query(
    "hash_fields",
    f"""WITH {E_SQL} SELECT event_id, substr(sha256('{SALT}' || f_USER_ID), 1, 16) AS user_id,
      substr(sha256('{SALT}' || f_REQUEST_ID), 1, 16) AS request_id FROM e""",
)
def hash_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = map_field()
    return entries(spark, sf_dir).select(
        "event_id",
        hash_value(field("USER_ID"), SALT).alias("user_id"),
        hash_value(field("REQUEST_ID"), SALT).alias("request_id"),
    )


@query(
    "mask_fields",
    f"""WITH {E_SQL} SELECT event_id, {_mask('f_EMAIL')} AS email, {_mask('f_CLIENT_IP')} AS client_ip,
      {_mask('f_API_FAMILY')} AS api_family FROM e""",
)
def mask_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_rules(entries(spark, sf_dir), [Rule("mask", ["EMAIL", "CLIENT_IP", "API_FAMILY"])])
    field = map_field()
    return rows.select(
        "event_id",
        field("EMAIL").alias("email"),
        field("CLIENT_IP").alias("client_ip"),
        field("API_FAMILY").alias("api_family"),
    )


@query(
    "mask_text_tokens",
    f"""WITH tokens AS (SELECT DISTINCT doc_id, unnest(string_split_regex(text, '\\s+')) AS token FROM documents)
      SELECT doc_id, token, {_mask('token')} AS masked FROM tokens
      WHERE contains(token, '@') OR regexp_full_match(token, '{_IPV4}')""",
)
def mask_text_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masking on the addresses that occur in free text, over whole texts."""
    tokens = (
        table(spark, sf_dir, "documents")
        .select("doc_id", F.explode(F.split("text", r"\s+")).alias("token"))
        .distinct()
    )
    masked = tokens.withColumn("masked", mask_value(F.col("token")))
    return masked.filter(F.col("masked") != "***")


@query(
    "drop_fields",
    f"""WITH {E_SQL} SELECT event_id, list_contains(json_keys(line), 'EMAIL') AS had_email,
      CAST(len(json_keys(line)) - 2 AS INT) AS fields FROM e""",
)
def drop_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = filled_entries(spark, sf_dir).withColumn(
        "had_email", F.array_contains(F.map_keys("payload"), "EMAIL")
    )
    rows = apply_rules(before, [Rule("drop_field", ["EMAIL", "CLIENT_IP", "NOT_THERE"])])
    return rows.select("event_id", "had_email", F.size("payload").alias("fields"))


@query(
    "regex_replace_fields",
    f"""WITH {E_SQL} SELECT event_id,
      regexp_replace(f_CLIENT_IP, '^(\\d+)\\.(\\d+)\\..*$', '\\2-\\1-$', 'g') AS client_ip,
      regexp_replace(f_EMAIL, '[aeiou]', '_', 'g') AS email FROM e""",
)
def regex_replace_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        Rule("regex_replace", ["CLIENT_IP"], pattern=r"^(?P<a>\d+)\.(\d+)\..*$", replacement=r"\2-\g<a>-$"),
        Rule("regex_replace", ["EMAIL"], pattern="[aeiou]", replacement="_"),
    ]
    rows = apply_rules(entries(spark, sf_dir), rules)
    field = map_field()
    return rows.select("event_id", field("CLIENT_IP").alias("client_ip"), field("EMAIL").alias("email"))


@query(
    "drop_rows",
    f"""WITH {E_SQL} SELECT event_id, event_type FROM e WHERE NOT (
      coalesce(f_LOGIN_STATUS, '') LIKE 'LOGIN%' AND regexp_full_match(coalesce(f_COUNTRY, ''), '[UD].'))
      AND NOT (coalesce(f_STATUS_CODE, '') = '400')""",
)
def drop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        Rule("drop_row", match={"LOGIN_STATUS": "LOGIN*", "COUNTRY": "[UD]?"}),
        Rule("drop_row", match={"STATUS_CODE": "400"}, name="bad_requests"),
    ]
    rows = apply_rules(entries(spark, sf_dir), rules)
    return rows.filter(F.col("dropped_by").isNull()).select("event_id", "event_type")


RULES = [
    Rule("mask", ["EMAIL"]),
    # Sees the masked address, not the original.
    Rule("drop_row", match={"EMAIL": "[*][*][*]@mail2*", "COUNTRY": "BR"}, name="brazil"),
    Rule("hash", ["USER_ID", "EMAIL"]),
    Rule("regex_replace", ["CLIENT_IP"], pattern=r"\.\d+$", replacement=".0"),
    Rule("drop_field", ["DB_TOTAL_TIME"]),
    Rule("drop_row", match={"DB_TOTAL_TIME": "?*"}, name="never"),
]


@query(
    "apply_rules",
    f"""WITH {E_SQL}, masked AS (SELECT *, {_mask('f_EMAIL')} AS m FROM e)
      SELECT event_id, ts AS original_ts,
      CASE WHEN m LIKE '***@mail2%' AND f_COUNTRY = 'BR' THEN 'brazil' END AS dropped_by,
      substr(sha256('{SALT}' || m), 1, 16) AS email, substr(sha256('{SALT}' || f_USER_ID), 1, 16) AS user,
      regexp_replace(f_CLIENT_IP, '\\.\\d+$', '.0') AS client_ip FROM masked""",
)
def rules_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later rules see earlier results; the cursor keeps the original time."""
    rows = apply_rules(entries(spark, sf_dir), RULES, SALT)
    field = map_field()
    return rows.select(
        "event_id",
        F.col("ts").alias("original_ts"),
        "dropped_by",
        field("EMAIL").alias("email"),
        field("USER_ID").alias("user"),
        field("CLIENT_IP").alias("client_ip"),
    )


@query(
    "redacted_line",
    f"""WITH {E_SQL} SELECT event_id, regexp_replace(regexp_replace(
      replace(line, '"EMAIL":"' || f_EMAIL || '"', '"EMAIL":"***@' || split_part(f_EMAIL, '@', 2) || '"'),
      '"DB_TOTAL_TIME":"[^"]*",', ''), '"CLIENT_IP":"([0-9.]*)"', CASE WHEN f_CLIENT_IP = '' THEN
      '"CLIENT_IP":"***"' ELSE '"CLIENT_IP":"' || regexp_replace(f_CLIENT_IP, '[0-9]+$', 'x') || '"' END)
      AS line FROM e""",
)
def redacted_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redaction comes before the line is written, so nothing derived from it leaks."""
    rules = [Rule("mask", ["EMAIL", "CLIENT_IP"]), Rule("drop_field", ["DB_TOTAL_TIME"])]
    rows = apply_rules(filled_entries(spark, sf_dir), rules)
    return rows.select("event_id", canonical_line(F.col("payload")).alias("line"))


@query(
    "redact_typed_columns",
    f"""SELECT c_custkey, substr(sha256('{SALT}' || c_name), 1, 16) AS c_name, '***' AS c_mktsegment,
      CASE WHEN c_nationkey = 7 THEN 'nation' END AS dropped_by FROM customer""",
)
def redact_typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        Rule("hash", ["c_name"]),
        Rule("drop_row", match={"c_nationkey": "7"}, name="nation"),
        Rule("mask", ["c_mktsegment"]),
        Rule("drop_field", ["c_nationkey", "c_acctbal"]),
    ]
    check_rules(rules, promoted_labels=["c_mktsegment"])
    return redact_columns(table(spark, sf_dir, "customer"), rules, SALT)


@query(
    "unsalted_hash_audit",
    f"""WITH {E_SQL} SELECT 'hash-0' AS rule, 'USER_ID' AS fields, count(*) AS rows FROM e
      WHERE f_USER_ID IS NOT NULL
      UNION ALL SELECT 'requests', 'REQUEST_ID', count(*) FROM e WHERE f_REQUEST_ID IS NOT NULL""",
)
def unsalted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings, with the number of rows each unsalted rule would have exposed."""
    rules = [Rule("hash", ["USER_ID"]), Rule("mask", ["EMAIL"]), Rule("hash", ["REQUEST_ID"], name="requests")]
    findings = unsalted_hash_audit(spark, rules, salt="")
    exposed = (
        filled_entries(spark, sf_dir)
        .select(F.explode(F.map_keys("payload")).alias("fields"))
        .groupBy("fields")
        .agg(F.count("*").alias("rows"))
    )
    return findings.join(exposed, "fields").select("rule", "fields", "rows")
