"""Shell globs as anchored regular expressions, matched case-sensitively."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPECIAL = set(r"\.^$|+()[]{}*?&~#-")


def glob_regex(pattern: str) -> str:
    """`*`, `?`, `[seq]` and `[!seq]` of a glob as a whole-string Java regex."""
    out: list[str] = []
    at = 0
    while at < len(pattern):
        char = pattern[at]
        if char == "*":
            out.append(".*")
        elif char == "?":
            out.append(".")
        elif char == "[":
            # A `]` right after the opening (or after `!`) is a member, not the end.
            first = at + (2 if pattern[at + 1 : at + 2] == "!" else 1)
            end = pattern.find("]", first + 1)
            if end < 0:
                out.append(r"\[")
            else:
                members = "".join("\\" + c if c in r"\[]^&~" else c for c in pattern[first:end])
                out.append(f"[{'^' if first == at + 2 else ''}{members}]")
                at = end
        else:
            out.append("\\" + char if char in _SPECIAL else char)
        at += 1
    return r"(?s)\A" + "".join(out) + r"\z"


def matches_glob(col: Column, pattern: str) -> Column:
    """True where the text matches; a glob without wildcards becomes plain equality."""
    if not set(pattern) & set("*?["):
        return col == F.lit(pattern)
    return F.lit(True) if pattern == "*" else col.rlike(glob_regex(pattern))


def matches_any(col: Column, patterns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, (matches_glob(col, p) for p in patterns), F.lit(False))


def first_match(col: Column, table: Sequence[tuple[str, object]], default: object) -> Column:
    """The value of the first glob that matches, in the order given."""
    if not table:
        return F.lit(default)
    head, *rest = table
    chain = F.when(matches_glob(col, head[0]), F.lit(head[1]))
    for pattern, value in rest:
        chain = chain.when(matches_glob(col, pattern), F.lit(value))
    return chain.otherwise(F.lit(default))
