"""Training-data pipeline over ``documents``: each stage is written as Parquet and reread as the next one's docs.

1. language ID: documents in no known language go;
2. MinHash near-dedup: one document of each class of near duplicates stays;
3. secret scan: secrets are blotted out of the texts;
4. source mix: each document comes as often as the mix takes it;
5. BPE: token count and digests of every document.

Every stage takes an empty table, nulls in any column, repeated rows, texts of any length and further columns of any name (kept
by all stages but the last); what it does with each is said in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from episodic.llm import bpe, langid, minhash, mixing, secrets
from episodic.llm.common import documents, small_batches
from episodic.operators.sinks import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return langid.keep_known_languages(docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return minhash.one_per_class(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secrets.without_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.mixed(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe.encode_documents(docs)


STAGES = [("language_id", language_id), ("minhash_dedup", minhash_dedup), ("secret_scan", secret_scan),
          ("source_mix", source_mix), ("bpe_encode", bpe_encode)]

#: Model fitting, signatures and the encoder have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
