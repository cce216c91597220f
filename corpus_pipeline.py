"""The corpus pipeline: five stages over `documents`, each working on all its predecessor kept.

1. toxicity: documents scored at or above the operator's threshold go;
2. quality: documents scored below the classifier's threshold go;
3. near_duplicates: one document of each group of near copies stays, the one of least doc_id;
4. decontamination: documents that hold a test item of `benchmark` go;
5. tokens: every remaining document's token ids (little-endian unsigned 32-bit integers) and the digest of
   what they decode to.

All stages but the last return the columns of documents. Rows without a doc_id cannot be scored by label or
named by a decision that is joined back; they take part as rows of their own and are kept by the filters.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import bpe, cotrain, decontaminate, minhash, toxicity
from tidelog.llm.frames import read, written
from tidelog.session import shared_folder

# Classifiers are learned from examples: their scores have no SQL form.
ORACLE_SQL = None


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id is not in `rejected`, with the columns of `docs`."""
    gone = written(rejected.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scores = toxicity.toxicity_scores(docs, read(spark, sf_dir, "labels"))
    return _without(docs, scores.filter("predicted = 1"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scores = cotrain.quality_scores(docs, read(spark, sf_dir, "labels"))
    return _without(docs, scores.filter("predicted = 0"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that repeat a kept doc_id are copies of it, so one of them stays."""
    groups = minhash.near_duplicate_groups(docs)
    kept = _without(docs, groups.filter("NOT kept"))
    named = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    return named.union(kept.filter("doc_id IS NULL"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    both = bpe.decode_documents(bpe.encode_documents(docs, ranks, pattern), ranks, pattern)
    return bpe.digests(both, "ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`.

    Each stage's rows are written as Parquet in the shared folder and read back by the next one.
    """
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
