"""The registered queries of the training-data operators (one ``opN_<name>`` each)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from episodic.llm import bpe, ctw, kmtree, langid, lattice, merkle, minhash, mixing, negatives, pages, secrets, shards, tokenfiles
from episodic.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


@query
def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(documents(spark, sf_dir))


@query
def op3_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(documents(spark, sf_dir))


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(documents(spark, sf_dir))


@query
def op5_e8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicate_vectors(_embeddings(spark, sf_dir))


@query
def op6_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmtree.nearest(_embeddings(spark, sf_dir))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.label_documents(documents(spark, sf_dir))


@query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, sf_dir))


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, sf_dir))


@query
def op10_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.count_tokens(documents(spark, sf_dir))


@query
def op11_butterfly_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_documents(documents(spark, sf_dir))


ORACLES["op11_butterfly_manifest"] = merkle.ORACLE


@query
def op12_one_bit_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(_embeddings(spark, sf_dir))


ORACLES["op12_one_bit_negatives"] = negatives.ORACLE


@query
def op13_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_pages(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))
