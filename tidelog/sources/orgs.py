"""Several organisations in one job, and their usage limits."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.labels import merge_maps, text_map
from tidelog.operators.progress import org_prefix

_LIMIT = "map<string,string>"


@dataclass(frozen=True)
class Org:
    """One organisation; an unknown id is left out of the labels."""

    name: str
    environment: str
    sf_org_id: str | None = None


def tag_org(entries: DataFrame, org: Org) -> DataFrame:
    """Labels of the org on every row, and its prefix on the progress key."""
    extra = text_map(
        {"org": org.name, "environment": org.environment, "sf_org_id": org.sf_org_id or None}
    )
    tagged = entries.withColumn("labels", merge_maps(F.col("labels"), extra))
    if "ckpt_key" in entries.columns:
        tagged = tagged.withColumn(
            "ckpt_key", F.concat(F.lit(org_prefix(org.name)), F.col("ckpt_key"))
        )
    return tagged


def union_orgs(per_org: Mapping[Org, DataFrame]) -> DataFrame:
    """Tagged rows of all orgs."""
    frames = (tag_org(entries, org) for org, entries in per_org.items())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_limits(snapshots: DataFrame, col: str = "limits") -> DataFrame:
    """One row per limit of a JSON document `{name: {"Max": n, "Remaining": n}}`.

    Entries without both numbers are skipped. All other columns are kept.
    """
    rest = [c for c in snapshots.columns if c != col]
    parsed = F.from_json(F.col(col), _LIMIT)
    exploded = snapshots.select(*rest, F.explode(parsed).alias("name", "_info"))

    def number(key: str) -> Column:
        return F.get_json_object("_info", f"$.{key}").try_cast("double").try_cast("bigint")

    return exploded.select(
        *rest, "name", number("Max").alias("max"), number("Remaining").alias("remaining")
    ).filter(F.col("max").isNotNull() & F.col("remaining").isNotNull())
