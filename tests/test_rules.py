"""Redaction rules against plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tidelog.operators.rules import (
    Rule,
    apply_rules,
    check_rules,
    java_replacement,
    unsalted_hash_audit,
)


def apply(spark, payload, rules, salt="s"):
    df = spark.createDataFrame([(payload,)], "payload map<string,string>")
    row = apply_rules(df, rules, salt).first()
    return row["payload"], row["dropped_by"]


def test_hash_is_salted_and_skips_null(spark):
    got, _ = apply(spark, {"a": "x", "b": None}, [Rule("hash", ["a", "b", "c"])], "salt")
    assert got == {"a": hashlib.sha256(b"saltx").hexdigest()[:16], "b": None}


@pytest.mark.parametrize(
    ("value", "masked"),
    [
        ("alice@example.com", "***@example.com"),
        ("a@b@c", "***@b@c"),
        ("@", "***@"),
        ("203.0.113.7", "203.0.113.x"),
        ("0.0.0.0", "0.0.0.x"),
        ("256.1.1.1", "***"),
        ("01.2.3.4", "***"),
        ("1.2.3", "***"),
        ("2001:db8::1", "***"),
        ("", "***"),
        ("plain", "***"),
    ],
)
def test_mask(spark, value, masked):
    assert apply(spark, {"v": value}, [Rule("mask", ["v"])])[0] == {"v": masked}


def test_drop_field(spark):
    assert apply(spark, {"a": "1", "b": "2"}, [Rule("drop_field", ["a", "z"])])[0] == {"b": "2"}


def test_regex_back_references(spark):
    rule = Rule("regex_replace", ["v"], pattern=r"(\w+)-(?P<n>\d+)", replacement=r"\g<n>:\1$")
    assert apply(spark, {"v": "ab-12 é-٣"}, [rule])[0] == {"v": "12:ab$ ٣:é$"}
    assert java_replacement(r"$\1\g<2>") == r"\$$1$2"


def test_drop_row_needs_every_match(spark):
    rule = Rule("drop_row", match={"type": "Sites", "uri": "/health*"}, name="probes")
    assert apply(spark, {"type": "Sites", "uri": "/healthz"}, [rule])[1] == "probes"
    assert apply(spark, {"type": "Sites", "uri": "/x"}, [rule])[1] is None
    assert apply(spark, {"type": "sites", "uri": "/healthz"}, [rule])[1] is None


def test_missing_field_reads_as_empty(spark):
    rule = Rule("drop_row", match={"gone": ""})
    assert apply(spark, {"a": "1"}, [rule])[1] == "drop_row-0"
    assert apply(spark, {"gone": None}, [rule])[1] == "drop_row-0"


def test_rules_run_in_order(spark):
    rules = [
        Rule("mask", ["v"]),
        Rule("drop_row", match={"v": "alice*"}, name="original"),
        Rule("drop_row", match={"v": "[*][*][*]@*"}, name="masked"),
        Rule("drop_row", match={"v": "*"}, name="later"),
    ]
    assert apply(spark, {"v": "alice@x"}, rules) == ({"v": "***@x"}, "masked")


def test_no_rules_changes_nothing(spark):
    assert apply(spark, {"a": "1"}, []) == ({"a": "1"}, None)


@pytest.mark.parametrize(
    "args",
    [
        {"action": "zap"},
        {"action": "hash"},
        {"action": "drop_row"},
        {"action": "drop_row", "match": {"a": "b"}, "fields": ["a"]},
        {"action": "regex_replace", "fields": ["a"]},
        {"action": "regex_replace", "fields": ["a"], "pattern": "("},
        {"action": "regex_replace", "fields": ["a"], "pattern": "(?P<x>a)(?P=x)"},
        {"action": "mask", "fields": ["a"], "pattern": "x"},
    ],
)
def test_bad_rules(args):
    with pytest.raises(ValueError):
        Rule(**args)


def test_dropping_a_promoted_label_is_an_error():
    check_rules([Rule("hash", ["a"])], ["a"])
    with pytest.raises(ValueError):
        check_rules([Rule("drop_field", ["a"])], ["a"])


def test_unsalted_audit(spark):
    rules = [Rule("mask", ["a"]), Rule("hash", ["b", "c"]), Rule("hash", ["d"], name="named")]
    assert unsalted_hash_audit(spark, rules, "salt").count() == 0
    got = [r[0] for r in unsalted_hash_audit(spark, rules, "").collect()]
    assert got == ["hash-1", "named"]
