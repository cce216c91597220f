"""Personal data by anchors: what an automaton finds, local parsers expand and validate.

One Aho-Corasick automaton passes over a text once and stops at at-signs, plus signs, digits, address schemes and
identifier cues. At each of them a parser that looks only at the characters around it fixes the boundaries of an
entity and checks it. Anchors of a kind come in text order and a parser starts no earlier than its last
entity ended, which makes the spans of a kind the leftmost non-overlapping ones. Every character is read by a
parser a bounded number of times, so long texts take time in proportion.

Base kinds:  email    name@label.label...
             ip       four dotted numbers of at most 255
             card     16 to 19 digits, single blanks or hyphens between, passing the Luhn sum
             phone    plus sign, 8 to 15 digits, blanks, brackets, dots and hyphens between
Added kinds: address  a web address with a user part (scheme://user[:password]@host), or mailto: and an email
             account  after a cue (account, acct, iban, ssn, passport): 6 to 18 digits, single blanks or hyphens
                      between, or an IBAN of 15 to 34 characters whose remainder modulo 97 is one
An entity that fails its check is dropped, and what it covered is not tried again for that kind.

Places are code points, the end is exclusive. Defined results: a null text is an empty one and has no spans;
rows without doc_id or with repeated ids are rows of their own; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.frames import modest_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "mailto:")
CUES = ("account", "acct", "iban", "ssn", "passport")

Spans = list[tuple[str, int, int]]

# Repeats are possessive: what follows them never shares a character with them.
_NAME = r"A-Za-z0-9._%+-"
_HOST = r"[A-Za-z0-9-]++"
_DOMAIN = re.compile(rf"{_HOST}(?:\.{_HOST})++")
_DIGITS = re.compile(r"[0-9]++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_GROUPED = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_DIALLED = re.compile(r"[\x20().0-9-]*+")
_LOGIN = re.compile(rf"[{_NAME}]++(?::[^\x00-\x20@/\"<>]*+)?@{_HOST}(?:\.{_HOST})*+")
_MAILBOX = re.compile(rf"[{_NAME}]++@{_HOST}(?:\.{_HOST})++")
_AFTER_CUE = re.compile(r"(?:\x20(?:no|number|nr))?[\x20.:#=]{1,4}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9])++")
_NAME_CHARACTERS = "".join(chr(c) for c in range(128) if re.match(rf"[{_NAME}]", chr(c)))


def luhn(digits: str) -> bool:
    """Every second digit from the right is doubled; the digits of all sum to a multiple of ten."""
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def valid_iban(code: str) -> bool:
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _small(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) <= 3 and int(number or "0") <= 255


class _Reader:
    """The entities of one text, anchor by anchor."""

    def __init__(self, text: str):
        self.text = text
        self.spans: Spans = []
        self.free = dict.fromkeys((*KINDS, "sign"), 0)

    def _found(self, kind: str, start: int, end: int, valid: bool) -> None:
        self.free[kind] = end
        if valid:
            self.spans.append((kind, start, end))

    def at_sign(self, start: int, end: int) -> None:
        """The name before the sign reaches back to the last sign or the last email at most."""
        low = max(self.free["email"], self.free["sign"])
        self.free["sign"] = end
        before = self.text[low:start]
        name = len(before) - len(before.rstrip(_NAME_CHARACTERS))
        domain = _DOMAIN.match(self.text, end) if name else None
        if domain:
            self._found("email", start - name, domain.end(), True)

    def digit(self, start: int, end: int) -> None:
        if start >= self.free["ip"]:
            four = _DOTTED.match(self.text, start)
            if four:
                self._found("ip", start, four.end(), all(map(_small, four[0].split("."))))
            else:
                self.free["ip"] = _DIGITS.match(self.text, start).end()
        if start >= self.free["card"]:
            grouped = _GROUPED.match(self.text, start)
            if grouped:
                digits = re.sub("[^0-9]", "", grouped[0]) if grouped.end() - start < 40 else ""
                self._found("card", start, grouped.end(), 16 <= len(digits) <= 19 and luhn(digits))

    def plus_sign(self, start: int, end: int) -> None:
        if start < self.free["phone"] or not _DIGITS.match(self.text, end):
            return
        run = self.text[end + 1 : _DIALLED.match(self.text, end + 1).end()].rstrip(" ().-")
        if len(run) > 1:
            self._found("phone", start, end + 1 + len(run), 8 <= 1 + sum(map(str.isdigit, run)) <= 15)

    def scheme(self, start: int, end: int) -> None:
        if start >= self.free["address"]:
            tail = (_MAILBOX if self.text[start] == "m" else _LOGIN).match(self.text, end)
            if tail:
                self._found("address", start, tail.end(), True)

    def cue(self, start: int, end: int) -> None:
        gap = _AFTER_CUE.match(self.text, end) if start >= self.free["account"] else None
        if not gap:
            return
        number = _GROUPED.match(self.text, gap.end())
        if number:
            digits = re.sub("[^0-9]", "", number[0]) if number.end() - number.start() < 40 else ""
            self._found("account", number.start(), number.end(), 6 <= len(digits) <= 18)
        elif code := _IBAN.match(self.text, gap.end()):
            self._found("account", code.start(), code.end(), code.end() - code.start() < 70 and valid_iban(code[0].replace(" ", "")))


def _automaton() -> ahocorasick.Automaton:
    anchors: dict[str, Callable] = {"@": _Reader.at_sign, "+": _Reader.plus_sign}
    anchors |= dict.fromkeys("0123456789", _Reader.digit) | dict.fromkeys(SCHEMES, _Reader.scheme)
    anchors |= {spelt: _Reader.cue for cue in CUES for spelt in (cue, cue.capitalize(), cue.upper())}
    found = ahocorasick.Automaton()
    for anchor, parser in anchors.items():
        found.add_word(anchor, (len(anchor), parser))
    found.make_automaton()
    return found


def personal_spans(text: str | None, anchors: ahocorasick.Automaton | None = None) -> Spans:
    """(kind, start, end) of all personal data in a text, by kind and then by place."""
    if not text:
        return []
    reader = _Reader(text)
    for last, (size, parser) in (anchors or _automaton()).iter(text):
        parser(reader, last + 1 - size, last + 1)
    return sorted(reader.spans, key=lambda span: (KINDS.index(span[0]), span[1]))


def _masked(text: str | None, spans: Spans) -> str | None:
    """The text with every covered stretch replaced by its first kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _per_text(make: Callable[[str | None, Spans], object], kind: pa.DataType):  # noqa: ANN202
    """The last column of every batch, a text, replaced by what `make` says of it and of its spans."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _automaton()
        for batch in batches:
            made = [make(text.as_py(), personal_spans(text.as_py(), anchors)) for text in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, kind)], names=batch.schema.names)

    return apply


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and `spans`, an array of (kind, start, end), of every row of `docs`."""
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("spans"))
    spans = _per_text(lambda _, spans: [dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans], _SPANS)
    name = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(spans, f"`{key}` {name}, spans array<struct<kind: string, start: bigint, end: bigint>>")


def masked_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with every piece of personal data in the text replaced by its kind in brackets."""
    modest_batches(docs.sparkSession)
    moved = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != text), F.col(text).cast("string"))
    return moved.mapInArrow(_per_text(_masked, pa.string()), moved.schema).select(*(F.col(f"`{c}`") for c in docs.columns))


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """`key`, a count for each base kind, the digest of the base spans and the list of all spans."""

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select(key, *counts, F.sha2(listed(of(*BASE_KINDS)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
