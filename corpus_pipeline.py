"""Corpus pipeline: the stages run in order, each on what the one before it kept.

Every stage but the last returns the columns of documents; other columns are left out.
Rows without an id stay unless an equal text has one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgloom.llm import exact, language, minhash, packing, pii
from kgloom.llm.common import checked_broadcast, read_table, shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages stay; `und` goes (no text or no letters)."""
    return language.accepted(docs.select(COLUMNS), language.train(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of the documents with equal text stays."""
    gone = exact.exact_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone"), "text_sha256").distinct()
    plain = F.translate(F.coalesce(F.col("text"), F.lit("")), exact.BLANKS.decode(), "")
    same = docs["doc_id"].eqNullSafe(F.col("gone")) & (F.sha2(plain, 256) == F.col("text_sha256"))
    return docs.join(checked_broadcast(gone, limit=250_000), same, "left_anti").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that with the smallest doc_id.  Texts that
    share a doc_id are judged one by one."""
    gone = minhash.near_duplicates(docs).where("not kept and doc_id is not null").select(F.col("row_key").alias("gone")).distinct()
    return docs.join(checked_broadcast(gone), minhash.row_key(docs) == F.col("gone"), "left_anti").select(COLUMNS)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in them becomes a mark of its kind."""
    return pii.redact(docs.select(COLUMNS), pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a batch."""
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("pii", redact_pii),
    ("packing", pack),
]

# Stages with classifiers, field inference and dynamic programming are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
