"""Label and metadata maps: merge, promote, render, check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.schema import ALLOWED_LABELS, RESERVED_LABELS


def text_map(values: Mapping[str, Column | str | None]) -> Column:
    """A map of the given entries; entries whose value is null are left out."""
    if not values:
        return F.expr("cast(map() as map<string,string>)")
    pairs: list[Column] = []
    for key, value in values.items():
        value = value if isinstance(value, Column) else F.lit(value)
        pairs += [F.lit(key), value.cast("string")]
    built = F.create_map(*pairs)
    if all(isinstance(value, str) for value in values.values()):
        return built
    return F.map_filter(built, lambda _, v: v.isNotNull())


def merge_maps(low: Column, high: Column) -> Column:
    """Union of two maps in which `high` wins, whatever the session does with repeated keys."""
    return F.map_zip_with(low, high, lambda _, a, b: F.coalesce(b, a))


def sorted_map(col: Column) -> Column:
    return F.map_from_entries(F.sort_array(F.map_entries(col)))


def stream_key(labels: Column) -> Column:
    """One string per exact label set, whatever the order of its keys."""
    return F.to_json(sorted_map(labels))


def promote(payload: Column, fields: Sequence[str]) -> Column:
    """Listed payload fields that are present and not null, as a map."""
    wanted = F.array(*[F.lit(f) for f in fields]) if fields else F.expr("cast(array() as array<string>)")
    return F.map_filter(payload, lambda k, v: F.array_contains(wanted, k) & v.isNotNull())


def promote_listed(payload: Column, fields: Column) -> Column:
    """As `promote`, with the field list in a column (per-type overrides)."""
    return F.map_filter(payload, lambda k, v: F.array_contains(fields, k) & v.isNotNull())


def render_labels(labels: Column) -> Column:
    """`{k="v",...}` with ascending keys; backslash, quote and newline escaped."""

    def pair(entry: Column) -> Column:
        value = F.replace(entry["value"], F.lit("\\"), F.lit("\\\\"))
        value = F.replace(value, F.lit('"'), F.lit('\\"'))
        value = F.replace(value, F.lit("\n"), F.lit("\\n"))
        return F.concat(entry["key"], F.lit('="'), value, F.lit('"'))

    pairs = F.transform(F.sort_array(F.map_entries(labels)), pair)
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def disallowed_labels(labels: Column, allowed: Sequence[str] = ALLOWED_LABELS) -> Column:
    """Sorted keys outside the allowed set."""
    return F.sort_array(
        F.array_except(F.map_keys(labels), F.array(*[F.lit(a) for a in allowed]))
    )


def static_labels(
    job: str,
    *,
    environment: str | None = None,
    org_id: str | None = None,
    operator_labels: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Deployment-wide labels; the operator's own win. Leave out environment and org id when the
    rows of several orgs are mixed, since those labels then differ per row."""
    labels = {"job": job, "service_name": job}
    if environment is not None:
        labels["environment"] = environment
    if org_id is not None:
        labels["sf_org_id"] = org_id
    labels.update(operator_labels or {})
    bad = sorted(k for k in labels if k not in ALLOWED_LABELS)
    if bad:
        raise ValueError(f"label keys outside the allowed set: {', '.join(bad)}")
    reserved = sorted(k for k in labels if k in RESERVED_LABELS)
    if reserved:
        raise ValueError(f"label keys only a row may set: {', '.join(reserved)}")
    return labels
