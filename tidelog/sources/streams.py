"""File-backed event streams with a replay position."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.session import broadcast_if_small, cut_lineage

PRESETS = ("EARLIEST", "LATEST")


def stream_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    start: str = "EARLIEST",
    max_files: int | None = None,
    max_bytes: str | None = None,
    file_format: str = "parquet",
    glob: str | None = None,
    position: str | None = None,
    max_position_age: str | None = None,
    max_file_age: str = "7d",
) -> DataFrame:
    """Rows of a growing folder. A running query resumes from its checkpoint; `start` only decides
    what a new one reads: everything (`EARLIEST`) or what arrives after the files that are there when
    it first starts (`LATEST`). That point is kept in the folder `position`, next to the checkpoint,
    so that a restart does not move it over files that arrived meanwhile.

    New `event_type=` folders under the path join a running query with its next micro-batch, and
    folders or files that vanish are ignored. `max_files` or `max_bytes` bound a micro-batch. A file whose
    modification time is `max_file_age` before that of the newest one seen is taken for a read one and skipped; a
    longer age keeps more names in the checkpoint.
    """
    if start not in PRESETS:
        raise ValueError(f"start must be one of {PRESETS}")
    reader = (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("ignoreMissingFiles", "true")
        .option("maxFileAge", max_file_age)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.load(path)
    if start == "EARLIEST":
        return rows
    if position is None:
        raise ValueError("LATEST needs a folder that keeps the starting point")
    there = start_listing(spark, path, position, glob, max_position_age)
    if there is None:
        return rows
    known = F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size")
    return rows.select("*", *known).join(broadcast_if_small(there), ["_path", "_size"], "left_anti").drop("_path", "_size")


POSITION = "_path string, _size bigint, taken timestamp"
REFUSED = "at timestamp, finding string"


def start_listing(
    spark: SparkSession, path: str, position: str, glob: str | None = None, max_age: str | None = None
) -> DataFrame | None:
    """The files (path and size) that were there at the first start; null if all files are to be read.

    Without a position the files of now are listed and kept. A position that cannot be read, that names no time, or
    that was taken longer than `max_age` ago is refused: reading starts from the earliest file, for what it
    excludes can no longer be trusted, and `position_findings` has a row that says so. It is kept as it is.
    """
    taken, refused = None, None
    system, folder = _folder(spark, position)
    if system.exists(folder):
        try:
            kept = cut_lineage(spark.read.schema(POSITION).parquet(position))
            taken = kept.agg(F.max("taken")).first()[0]
            stale = max_age and kept.agg(F.max("taken") < F.current_timestamp() - F.expr(f"INTERVAL {max_age}")).first()[0]
            refused = "no position in it" if taken is None else "older than allowed" if stale else None
        except (PySparkException, Py4JJavaError):
            refused = "cannot be read"
    else:
        # Only the listing is read, not the files.
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        found = found.option("pathGlobFilter", glob) if glob else found
        listed = found.load(path).select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size"))
        mark = spark.range(1).select(F.lit(None).cast("string").alias("_path"), F.lit(None).cast("bigint").alias("_size"))
        listed.union(mark).withColumn("taken", F.current_timestamp()).write.parquet(position)
        kept = spark.read.schema(POSITION).parquet(position)
    if refused:
        finding = spark.range(1).select(F.current_timestamp().alias("at"), F.lit(refused).alias("finding"))
        finding.write.mode("append").parquet(f"{position}-findings")
        return None
    return kept.filter("_path IS NOT NULL").select("_path", "_size")


def position_findings(spark: SparkSession, position: str) -> DataFrame:
    """`(at, finding)`: when a start position was refused, and why."""
    system, folder = _folder(spark, f"{position}-findings")
    if not system.exists(folder):
        return spark.createDataFrame([], REFUSED)
    return spark.read.schema(REFUSED).parquet(f"{position}-findings")


def _folder(spark: SparkSession, path: str):  # noqa: ANN202
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()), named


def quarantine_poison(
    rows: DataFrame, known_schemas: DataFrame, payload: str = "payload", schema_id: str = "schema_id"
) -> DataFrame:
    """Parse JSON payloads into `body VARIANT`; add `poison` for those that do not parse.

    An unknown schema id is not poison: skipping it would lose rows that become readable once the
    schema is there, so it fails the batch.
    """
    known = broadcast_if_small(known_schemas.select(F.col("schema_id").alias("_known")).distinct())
    checked = rows.join(known, F.col(schema_id) == F.col("_known"), "left")
    body = F.when(
        F.col("_known").isNull(),
        F.raise_error(F.concat(F.lit("unknown schema id "), F.coalesce(schema_id, F.lit("null")))),
    ).otherwise(F.try_parse_json(F.col(payload)))
    return checked.withColumn("body", body).withColumn("poison", F.col("body").isNull()).drop("_known")
