"""The opN_ queries: each applies its operator to the whole table with production parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from . import exact, fingerprint, html, language, manifest, minhash, packing, pieces, pii, runlength, secrets, simhash, whitening
from .common import read_table, shared_dir

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents")).drop("row_key")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    return secrets.report(secrets.scan_into(read_table(spark, sf_dir, "documents"), ledger))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.neighbours(read_table(spark, sf_dir, "documents"))


def op5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read_table(spark, sf_dir, "pages"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    return pieces.digest(read_table(spark, sf_dir, "documents"), tokenizer)


def op9_runlength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlength.remove_repeats(read_table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.fit(docs))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(read_table(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_secrets": op2_secrets,
    "op3_packing": op3_packing,
    "op4_fingerprint": op4_fingerprint,
    "op5_exact": op5_exact,
    "op6_language": op6_language,
    "op7_html": op7_html,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_runlength": op9_runlength,
    "op10_pii": op10_pii,
    "op11_manifest": op11_manifest,
    "op12_simhash": op12_simhash,
    "op13_whitening": op13_whitening,
}
