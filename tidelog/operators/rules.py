"""Declarative redaction and row filters, compiled to one expression per payload."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.globs import matches_glob

ACTIONS = ("hash", "mask", "drop_field", "regex_replace", "drop_row")

# Fixed value: a strict dotted quad.
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"\A{_OCTET}([.]{_OCTET}){{3}}\z"


@dataclass(frozen=True)
class Rule:
    """One rule. `drop_row` takes `match` (field -> glob); all others take `fields`."""

    action: str
    fields: Sequence[str] = ()
    match: Mapping[str, str] = field(default_factory=dict)
    pattern: str | None = None
    replacement: str = ""
    name: str = ""

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(f"unknown rule action {self.action!r}")
        if self.action == "drop_row":
            if not self.match:
                raise ValueError("drop_row needs a non-empty match")
            if self.fields:
                raise ValueError("drop_row takes match, not fields")
        elif not self.fields:
            raise ValueError(f"{self.action} needs fields")
        if self.action == "regex_replace":
            if not self.pattern:
                raise ValueError("regex_replace needs a pattern")
            java_pattern(self.pattern)
        elif self.pattern is not None:
            raise ValueError(f"{self.action} takes no pattern")


def rule_name(rule: Rule, index: int) -> str:
    return rule.name or f"{rule.action}-{index}"


def check_rules(rules: Iterable[Rule], promoted_labels: Iterable[str] = ()) -> None:
    """Removing a field that is promoted to a label would silently remove the label."""
    removed = {f for r in rules if r.action == "drop_field" for f in r.fields}
    clash = sorted(removed & set(promoted_labels))
    if clash:
        raise ValueError(f"drop_field removes fields promoted to labels: {', '.join(clash)}")


def java_pattern(pattern: str) -> str:
    """A Python pattern in Java's dialect; constructs Java does not know are refused."""
    try:
        re.compile(pattern)
    except re.error as error:
        raise ValueError(f"pattern {pattern!r} does not compile: {error}") from error
    if re.search(r"\(\?P=|\(\?\(|\\Z", pattern):
        raise ValueError(f"pattern {pattern!r} uses a construct the JVM's regexes lack")
    # Python classes such as \\d and \\w are Unicode-aware; Java's only with this flag.
    return "(?U)" + re.sub(r"\(\?P<", "(?<", pattern)


def java_replacement(replacement: str) -> str:
    r"""`\1` and `\g<1>` become `$1`; a literal `$` is escaped."""
    text = replacement.replace("$", r"\$")
    text = re.sub(r"\\g<([A-Za-z_]\w*)>", r"${\1}", text)
    return re.sub(r"\\(?:g<(\d+)>|(\d))", lambda m: "$" + (m[1] or m[2]), text)


def hash_value(value: Column, salt: str) -> Column:
    """Stable pseudonym: 16 hex digits of the salted sha256."""
    return F.substring(F.sha2(F.concat(F.lit(salt), value), 256), 1, 16)


def mask_value(value: Column) -> Column:
    """Emails keep the domain, IPv4 addresses their first three parts, all else is `***`."""
    after_at = F.substring(value, F.instr(value, "@") + 1, F.length(value))
    return (
        F.when(F.contains(value, F.lit("@")), F.concat(F.lit("***@"), after_at))
        .when(value.rlike(_IPV4), F.concat(F.substring_index(value, ".", 3), F.lit(".x")))
        .when(value.isNotNull(), F.lit("***"))
    )


def drops_row(rule: Rule, read: Callable[[str], Column]) -> Column:
    """True when every field matches its glob; a missing or null field reads as empty text."""
    tests = (matches_glob(F.coalesce(read(f), F.lit("")), g) for f, g in rule.match.items())
    return reduce(lambda a, b: a & b, tests)


def _edit(rule: Rule, salt: str) -> Callable[[Column], Column]:
    if rule.action == "hash":
        return lambda v: hash_value(v, salt)
    if rule.action == "mask":
        return mask_value
    pattern, replacement = java_pattern(rule.pattern or ""), java_replacement(rule.replacement)
    return lambda v: F.regexp_replace(v, pattern, replacement)


def apply_rules(
    df: DataFrame, rules: Sequence[Rule], salt: str = "", payload: str = "payload"
) -> DataFrame:
    """Apply the rules in order to a MAP payload; each sees the result of those before.

    No row is removed: `dropped_by` names the first `drop_row` rule that matched, so that dropped
    rows can still be counted and still move the cursor. Rules after the match do not matter.
    """
    dropped = F.lit(None).cast("string")
    for index, rule in enumerate(rules):
        col = F.col(payload)
        if rule.action == "drop_row":
            hit = drops_row(rule, col.getItem)
            dropped = F.coalesce(dropped, F.when(hit, F.lit(rule_name(rule, index))))
            df = df.withColumn("dropped_by", dropped)
            dropped = F.col("dropped_by")
            continue
        listed = F.array(*[F.lit(f) for f in rule.fields])
        if rule.action == "drop_field":
            new = F.map_filter(col, lambda k, _: ~F.array_contains(listed, k))
        else:
            edit = _edit(rule, salt)
            new = F.transform_values(
                col, lambda k, v: F.when(F.array_contains(listed, k), edit(v)).otherwise(v)
            )
        df = df.withColumn(payload, new)
    return df if "dropped_by" in df.columns else df.withColumn("dropped_by", dropped)


def redact_columns(df: DataFrame, rules: Sequence[Rule], salt: str = "") -> DataFrame:
    """The same rules on typed columns instead of a payload map; untouched columns stay prunable."""
    dropped = F.lit(None).cast("string")
    for index, rule in enumerate(rules):
        if rule.action == "drop_row":
            hit = drops_row(rule, lambda f: F.col(f).cast("string"))
            df = df.withColumn("dropped_by", F.coalesce(dropped, F.when(hit, F.lit(rule_name(rule, index)))))
            dropped = F.col("dropped_by")
        elif rule.action == "drop_field":
            df = df.drop(*rule.fields)
        else:
            edit = _edit(rule, salt)
            present = [f for f in rule.fields if f in df.columns]
            df = df.withColumns({f: edit(F.col(f).cast("string")) for f in present})
    return df if "dropped_by" in df.columns else df.withColumn("dropped_by", dropped)


def unsalted_hash_audit(spark: SparkSession, rules: Sequence[Rule], salt: str) -> DataFrame:
    """One finding per hash rule that would run without a salt."""
    found = [
        (rule_name(r, i), ", ".join(r.fields), "hash without a salt can be reversed by lookup")
        for i, r in enumerate(rules)
        if r.action == "hash" and not salt
    ]
    return spark.createDataFrame(found, "rule string, fields string, finding string")
