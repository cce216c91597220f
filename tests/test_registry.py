"""Every registered query runs on the smallest tables and agrees with its SQL."""

import os

import duckdb
import pytest
from pyspark.sql import types as T

from tidelog.registry import oracle_sql, queries

SF_DIR = os.environ.get("TIDELOG_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    return float(f"{value:.9g}") if isinstance(value, float) else value


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    nested = (T.MapType, T.ArrayType, T.StructType, T.TimestampType)
    assert not [f.name for f in df.schema.fields if isinstance(f.dataType, nested)]
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.sql(oracle_sql()[name])
    assert sorted(result.columns) == columns
    place = [result.columns.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in place) for r in result.fetchall()), key=repr)
    assert got == want
