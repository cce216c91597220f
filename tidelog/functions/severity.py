"""Severity of an event from the status fields it happens to carry."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field names, and the words that mean success or absence.
ERROR_FIELDS = ("EXCEPTION_MESSAGE", "EXCEPTION_TYPE", "ERROR_MESSAGE", "ERROR_CODE")
OUTCOME_FIELDS = ("OPERATION_STATUS", "Status")
SUCCESS_WORDS = ("s", "success", "successful", "ok", "complete", "completed", "true")
ABSENT_WORDS = ("", "0", "none", "null", "na", "n/a")
LOGIN_OK = "LOGIN_NO_ERROR"

_BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _says(col: Column, words: Sequence[str] | str) -> Column:
    """Whether the trimmed text is one of the words in any case; one regex beats trim and lower."""
    body = words if isinstance(words, str) else "|".join(words)
    return col.rlike(rf"(?i)\A[{_BLANKS}]*(?:{body})[{_BLANKS}]*\z")


def _absent(col: Column) -> Column:
    return _says(col, ABSENT_WORDS)


def present(col: Column) -> Column:
    """Trimmed text, or null where the value only says that there is none."""
    return F.when(~_absent(col), F.btrim(col, F.lit(_BLANKS)))


def _success_or_warn(col: Column) -> Column:
    return F.when(_says(col, SUCCESS_WORDS), F.lit("info")).when(~_absent(col), F.lit("warn"))


def _http_level(col: Column) -> Column:
    """By pattern: whole numbers of any length, without a cast that could overflow."""
    return (
        F.when(_says(col, "0*(?:[5-9][0-9]{2}|[1-9][0-9]{3,})"), F.lit("error"))
        .when(_says(col, "0*4[0-9]{2}"), F.lit("warn"))
        .when(_says(col, "0*[1-3][0-9]{2}"), F.lit("info"))
    )


def derive_level(field: Callable[[str], Column]) -> Column:
    """`error`, `warn` or `info`; `field(name)` reads one payload field as text.

    Signals are tried from the most to the least specific: an explicit error field, the HTTP status,
    the request status, the login outcome, then the generic outcome fields. Every test names its
    field once or twice, so that the expression stays small.
    """
    # A missing field makes its test null, which neither helps nor hinders the others.
    failed = reduce(lambda a, b: a | b, (~_absent(field(f)) for f in ERROR_FIELDS))
    login = field("LOGIN_STATUS")
    return F.coalesce(
        F.when(failed, F.lit("error")),
        _http_level(field("STATUS_CODE")),
        _success_or_warn(field("REQUEST_STATUS")),
        F.when(_says(login, LOGIN_OK), F.lit("info")).when(~_absent(login), F.lit("warn")),
        *[_success_or_warn(field(name)) for name in OUTCOME_FIELDS],
        F.lit("info"),
    )
