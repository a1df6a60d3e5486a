"""The registered queries of this package: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.llm import (dartminhash, decontamination, fingerprints, hnsw, language_id, merkle, mixing, packing, periodic_runs,
                        sharding, suffix_tree_lm, token_counts, url_filter)
from tabreg.llm.common import ship_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return run


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@_query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, sf_dir, "documents"))


@_query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


#: Fixed values of the query: rules as host and path.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@_query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


@_query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's language; the character model is fitted on labelled documents."""
    return language_id.identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@_query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's count of pieces."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@_query
def op6_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector by inner product."""
    return hnsw.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


@_query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its raked weight, sampling probability and draw."""
    rows = mixing.mix(table(spark, sf_dir, "documents"), mixing.document_dims())
    return rows.select("doc_id", F.col("_mix_source").alias("source"), F.col("_mix_lang").alias("lang"),
                       F.col("_mix_topic").alias("topic"), F.col("_mix_tokens").alias("tokens"),
                       F.round("_mix_weight", 6).alias("weight"), F.round("_mix_probability", 6).alias("probability"),
                       F.col("_mix_sampled").alias("sampled"))


ORACLE["op7_mixing"] = mixing.oracle_sql()


@_query
def op8_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.fit_and_score(table(spark, sf_dir, "documents"))


@_query
def op9_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its near-duplicate class (smallest doc_id of the class)."""
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


@_query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 contiguous shards by text hash and doc_id, near equal in bytes, equal texts together."""
    return sharding.shard_texts_by_bytes(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@_query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, its proof up to the root, and whether the proof holds."""
    return merkle.verified(table(spark, sf_dir, "documents"))


ORACLE["op11_merkle_manifest"] = merkle.oracle_sql()


@_query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs of words and its text without their repetitions."""
    return periodic_runs.run_report(table(spark, sf_dir, "documents"))


@_query
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words and items of the benchmark."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op13_decontamination"] = decontamination.oracle_sql()
