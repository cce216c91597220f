"""The registered queries against their SQL, and the pipeline stage by stage."""

import os

import duckdb
import pytest

import corpus_pipeline
from tidelog.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("TIDELOG_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = con.sql(SQL[name])
    place = [result.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in place) for r in result.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want


def test_all_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


def test_the_pipeline_keeps_the_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    left = before
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
        now = docs.count()
        assert 0.6 * before < now <= left
        left = now
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert tokens.count() == left == corpus_pipeline.run(spark, SF_DIR).count()
    digests = docs.selectExpr("doc_id", "sha2(cast(text AS BINARY), 256) AS d").join(tokens, "doc_id")
    assert digests.filter("d <> decoded_sha256").count() == 0


def test_stages_take_odd_and_empty_documents(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, docs, SF_DIR)
            assert left.columns == docs.columns
            assert left.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count()
    kept = corpus_pipeline.near_duplicate_stage(spark, odd, SF_DIR).collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and {1, 2, 3, 7} <= set(ids) and 8 not in ids
    assert sum(r.doc_id is None for r in kept) == 2
