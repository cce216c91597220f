"""Aggregations and top-k (AGG, SRT)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.identity import keep_sampled
from tidelog.functions.payload import canonical_line, map_field
from tidelog.functions.times import instant, seconds_between
from tidelog.operators import series, sketches
from tidelog.operators.rules import Rule, apply_rules
from tidelog.operators.running import numbered
from tidelog.plans import quality
from tidelog.registry.base import query
from tidelog.registry.scalars import BUCKET_SQL, PARSED_SQL
from tidelog.registry.shape import _LABELS_SQL, _SHAPED_SQL, shaped
from tidelog.registry.tables import E_SQL, entries, filled_entries, raw_events, table
from tidelog.schema import LAG_BOUNDS
from tidelog.session import shared_folder

NOW = "2024-01-31 00:00:00"
HOUR = "1 hour"


@query(
    "count_over_time",
    f"""WITH {E_SQL} SELECT time_bucket(INTERVAL 1 HOUR, ts) AS step_start, source, count(*) AS n FROM e GROUP BY ALL""",
)
def count_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.count_over_time(entries(spark, sf_dir), ["source"], HOUR)


@query(
    "rate_by_type",
    f"""WITH {E_SQL} SELECT time_bucket(INTERVAL 1 HOUR, ts) AS step_start, event_type, count(*) AS n,
      count(*) / 3600.0::DOUBLE AS rate FROM e GROUP BY ALL""",
)
def rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.rate(entries(spark, sf_dir), 3600, ["event_type"], HOUR)


@query("group_count", "SELECT count(DISTINCT user_id) AS users FROM events")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.group_count(table(spark, sf_dir, "events"), "user_id", "users")


@query(
    "quantiles_by_type",
    " UNION ALL ".join(
        f"SELECT event_type, {q}::DOUBLE AS q, quantile_cont(value, {q}) AS value FROM events GROUP BY 1"
        for q in (0.5, 0.95, 0.99)
    ),
)
def quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", "value")
    return series.quantiles(rows, F.col("value"), [0.5, 0.95, 0.99], ["event_type"])


@query(
    "quantiles_overall",
    """SELECT 0.25::DOUBLE AS q, quantile_cont(l_extendedprice, 0.25) AS value FROM lineitem
      UNION ALL SELECT 0.999, quantile_cont(l_extendedprice, 0.999) FROM lineitem""",
)
def quantiles_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.quantiles(table(spark, sf_dir, "lineitem"), F.col("l_extendedprice"), [0.25, 0.999])


@query(
    "quantile_sketch_error",
    """SELECT event_type, true AS close FROM events GROUP BY 1""",
)
def sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-pass sketch stays within its rank error of the exact median."""
    rows = table(spark, sf_dir, "events").select("event_type", "value")
    near = series.approx_quantiles(rows, F.col("value"), [0.495, 0.505], ["event_type"])
    exact = series.quantiles(rows, F.col("value"), [0.5], ["event_type"]).withColumnRenamed("value", "exact")
    band = near.groupBy("event_type").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    inside = (F.col("exact") >= F.col("lo")) & (F.col("exact") <= F.col("hi"))
    return band.join(exact, "event_type").select("event_type", inside.alias("close"))


@query(
    "average_of_field",
    f"WITH {E_SQL} SELECT source, avg(try_cast(f_DB_TOTAL_TIME AS DOUBLE)) AS average FROM e GROUP BY 1",
)
def average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.average(entries(spark, sf_dir), map_field()("DB_TOTAL_TIME"), ["source"])


_LAG_SQL = "value * value * 5"
_HIST_SQL = (
    "hist AS (SELECT event_type, le, count(*) FILTER (lag <= le) AS n FROM "
    f"(SELECT event_type, {_LAG_SQL} AS lag FROM events) x, "
    f"(SELECT unnest([{', '.join(f'{b}::DOUBLE' for b in LAG_BOUNDS)}, 'infinity'::DOUBLE]) AS le) b GROUP BY ALL)"
)


@query("lag_histogram", f"WITH {_HIST_SQL} SELECT event_type, CASE WHEN isinf(le) THEN -1 ELSE le END AS le, n FROM hist")
def lag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative counts at the lag bounds; -1 stands for the unbounded bucket."""
    lag = F.expr(_LAG_SQL)
    hist = series.histogram(table(spark, sf_dir, "events"), lag, ["event_type"])
    return hist.withColumn("le", F.when(F.col("le") == float("inf"), -1.0).otherwise(F.col("le")))


_QUANTILE_SQL = """ordered AS (SELECT *, max(n) OVER (PARTITION BY event_type) AS total,
    coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(n) OVER w, 0) AS before
    FROM hist WINDOW w AS (PARTITION BY event_type ORDER BY le)),
  first AS (SELECT * FROM ordered WHERE n >= {q} * total
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY le) = 1)
  SELECT event_type, CASE WHEN isinf(le) THEN low ELSE low + (le - low) * (({q} * total - before) / (n - before)) END
    AS quantile FROM first"""


@query("histogram_quantile", f"WITH {_HIST_SQL}, {_QUANTILE_SQL.format(q='0.95::DOUBLE')}")
def histogram_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = series.histogram(table(spark, sf_dir, "events"), F.expr(_LAG_SQL), ["event_type"])
    return series.histogram_quantile(hist, 0.95, ["event_type"])


@query(
    "floored_ratio",
    f"""WITH {E_SQL} SELECT org, count(*) FILTER (f_SUCCESS = '0') / greatest(count(f_SUCCESS)::DOUBLE, 0.0001) * 100 AS percent
      FROM e GROUP BY 1""",
)
def floored_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = entries(spark, sf_dir).withColumn("ok", map_field()("SUCCESS"))
    ratio = series.floored_ratio(F.count_if(F.col("ok") == "0"), F.count("ok"), 0.0001, 100.0)
    return rows.groupBy("org").agg(ratio.alias("percent"))


@query(
    "min_across_series",
    """SELECT min(ratio) AS lowest FROM (SELECT user_id, count(*) FILTER (value < 20) / count(*) AS ratio FROM events GROUP BY 1)""",
)
def min_across(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_user = table(spark, sf_dir, "events").groupBy("user_id")
    low = per_user.agg(F.count_if(F.col("value") < 20).alias("value"))
    return series.vector_ratio(low, per_user.agg(F.count("*").alias("value")), ["user_id"]).agg(
        F.min("ratio").alias("lowest")
    )


@query(
    "stream_sizes",
    f"""WITH {E_SQL} SELECT {_LABELS_SQL} AS stream_key, count(*) AS entries,
      CAST(sum(octet_length(encode(line))) AS BIGINT) AS bytes FROM e GROUP BY 1""",
)
def stream_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.stream_sizes(shaped(spark, sf_dir))


@query(
    "outcome_counts",
    f"""WITH {E_SQL}, o AS (SELECT source, coalesce(f_COUNTRY = 'IN', false) AS india, coalesce(f_STATUS_CODE = '200', false) AS ok,
        {BUCKET_SQL.format("coalesce(nullif(f_REQUEST_ID, ''), line)")} >= 9000 AS sampled,
        octet_length(encode(line)) > 290 AS cut, {PARSED_SQL} IS NULL AS untimed FROM e),
      d AS (SELECT *, NOT india AND NOT ok AS kept, NOT india AND NOT ok AND NOT sampled AS delivered FROM o),
      c AS (SELECT source, unnest(['filtered:india', 'filtered:drop_row-1', 'filtered', 'sampled_out', 'truncated', 'time_fallback', 'delivered']) AS outcome,
        unnest([india, ok AND NOT india, NOT kept, kept AND sampled, delivered AND cut, delivered AND untimed, delivered]) AS hit FROM d)
      SELECT source, outcome, count(*) FILTER (hit) AS n FROM c GROUP BY 1, 2""",
)
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every counter of a run by source, in one pass; rows may raise several."""
    rules = [
        Rule("drop_row", match={"COUNTRY": "IN"}, name="india"),
        Rule("drop_row", match={"STATUS_CODE": "200"}),
    ]
    rows = apply_rules(shaped(spark, sf_dir, max_line_bytes=290), rules)
    request = F.col("payload").getItem("REQUEST_ID")
    key = F.coalesce(F.when(request != "", request), canonical_line(F.col("payload")))
    flags = quality.outcome_flags(
        F.col("dropped_by"), ~keep_sampled(key, 0.9), F.col("truncated"), F.col("used_fallback"),
        rules=("india", "drop_row-1"),
    )
    return quality.outcome_counts(rows, flags, ["source"])


@query(
    "run_summary",
    f"""WITH {E_SQL} SELECT count(DISTINCT event_type) AS files, count(*) FILTER (k <> 99) AS rows_pushed,
      CAST(sum(octet_length(encode(line))) AS BIGINT) AS bytes,
      (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS elapsed_seconds FROM e""",
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filled_entries(spark, sf_dir).withColumn("line", canonical_line(F.col("payload")))
    return quality.run_summary(rows, "event_type", F.col("k") == 99, F.col("ts"), F.col("ts"))


@query(
    "cardinality_report",
    f"""WITH {E_SQL}, {_SHAPED_SQL}, cells AS (
        SELECT key AS label, json_extract_string(labels, '$.' || key) AS v
        FROM (SELECT labels, unnest(json_keys(labels)) AS key FROM shaped)
        UNION ALL SELECT '(stream)', labels FROM shaped)
      SELECT label, count(DISTINCT v) AS distinct_values FROM cells GROUP BY 1""",
)
def cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cardinality_report(shaped(spark, sf_dir))


# --- top-k --------------------------------------------------------------------------------------


@query(
    "topk_users",
    "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 15",
)
def topk_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = series.count_over_time(table(spark, sf_dir, "events"), ["user_id"])
    return series.topk(counted, 15, "n", ["user_id"])


@query(
    "topk_users_per_day",
    """SELECT time_bucket(INTERVAL 1 DAY, ts) AS step_start, user_id, count(*) AS n,
      CAST(row_number() OVER (PARTITION BY time_bucket(INTERVAL 1 DAY, ts) ORDER BY count(*) DESC, user_id) AS INT) AS rank
      FROM events GROUP BY 1, 2 QUALIFY rank <= 10""",
)
def topk_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = series.count_over_time(raw_events(spark, sf_dir), ["user_id"], "1 day")
    return series.topk_per_step(counted, 10, "n", ["user_id"])


@query(
    "order_inside_file",
    """SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS place FROM events""",
)
def order_inside_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of a row in its file by time, files of any size."""
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    placed = numbered(rows, ["event_type"], ["value", "event_id"], "place")
    return placed.select("event_type", "event_id", (F.col("place") + 1).alias("place"))


@query(
    "arrival_lag_seconds",
    f"SELECT event_type, max((epoch_us(TIMESTAMP '{NOW}') - epoch_us(ts)) / 1e6) AS worst FROM events GROUP BY 1",
)
def worst_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lag = seconds_between(instant(NOW), F.col("ts"))
    return raw_events(spark, sf_dir).groupBy("event_type").agg(F.max(lag).alias("worst"))


_SPANS_SQL = """spans AS (SELECT 'day' AS span, date_trunc('day', ts) AS start, event_type, user_id, value FROM raw
      UNION ALL SELECT 'week', date_trunc('week', ts), 'all', user_id, value FROM raw)"""


@query(
    "merged_step_sketches",
    f"""WITH raw AS (SELECT * FROM events), {_SPANS_SQL} SELECT span, start, event_type, count(*) AS n, true AS users_close, true AS median_close, true AS p95_close
      FROM spans GROUP BY 1, 2, 3""",
)
def merged_step_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days by type and weeks over all types from one stored table of hours: counts, and whether distinct users
    and quantiles lie within the sketches' bounds of the exact figures."""
    rows = raw_events(spark, sf_dir).select("ts", "event_type", "user_id", "value")
    folder = f"{shared_folder(spark)}/sketches-{uuid.uuid4().hex}"
    sketches.step_sketches(rows, "1 hour", ["event_type"], distinct=F.col("user_id"), value=F.col("value")).write.parquet(folder)
    hours = spark.read.parquet(folder)
    day, week = F.date_trunc("day", "ts"), F.date_trunc("week", "ts")
    found = []
    for span, start, kind in (("day", day, F.col("event_type")), ("week", week, F.lit("all"))):
        own = hours.withColumn("ts", F.col("step_start")).withColumn("start", start).withColumn("event_type", kind)
        merged = sketches.merged_sketches(own, ["start", "event_type"])
        merged = merged.select(
            "start", "event_type", "n", sketches.distinct_of().alias("users"),
            *(sketches.quantile_of(q).alias(name) for q, name in ((0.5, "median"), (0.95, "p95"))),
        )
        exact = rows.withColumn("start", start).withColumn("event_type", kind)
        # The share of values below and up to the estimate encloses the quantile but for the sketch's error.
        placed = exact.join(merged, ["start", "event_type"])

        def close(name: str, q: float) -> Column:
            below, upto = F.avg((F.col("value") < F.col(name)).cast("int")), F.avg((F.col("value") <= F.col(name)).cast("int"))
            return ((below <= q + sketches.RANK_ERROR + 1 / F.count("*")) & (upto >= q - sketches.RANK_ERROR - 1 / F.count("*"))).alias(f"{name}_close")

        users = F.count_distinct("user_id")
        near = F.abs(F.first("users") - users) <= F.greatest(F.lit(1.0), users * sketches.DISTINCT_ERROR)
        checked = placed.groupBy("start", "event_type").agg(F.first("n").alias("n"), near.alias("users_close"), close("median", 0.5), close("p95", 0.95))
        found.append(checked.withColumn("span", F.lit(span)))
    return found[0].unionByName(found[1])
