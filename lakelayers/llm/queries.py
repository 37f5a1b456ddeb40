"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.llm import (
    bytebpe, chaining, digest_index, feistel, importance, minhash, mixing, periodic_runs, pii, spot_prints, token_frames, vector_blocks,
    vector_codes,
)
from lakelayers.llm.common import documents
from lakelayers.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}



def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        reachable(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return run


def reachable(spark: SparkSession) -> None:
    """Lets Python workers of this machine import the package wherever the driver was
    started; on a cluster it comes with --py-files or the image."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


@query
def op1_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    files = token_frames.write_token_files(documents(spark, folder), path)
    return files.read().select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op2_importance(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return importance.resample(documents(spark, folder), labels)


@query
def op3_water_filling(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_digest_index(spark: SparkSession, folder: str) -> DataFrame:
    found = digest_index.deduplicate(documents(spark, folder))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op5_pigeonhole(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_blocks.near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return found.select("vec_id", "n_links", "component_id", "kept")


@query
def op6_chained_passages(spark: SparkSession, folder: str) -> DataFrame:
    return chaining.shared_passages(documents(spark, folder))


@query
def op7_weak_labels(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.personal_data(documents(spark, folder))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_secret", "secrets")


@query
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = bytebpe.encode_documents(documents(spark, folder), path, public_tokenizers.PATTERN, ids=False, offsets=False)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "offsets_crc32")


@query
def op9_minhash_bayes(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(documents(spark, folder), words=3, threshold=(85, 100))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op10_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    found = feistel.assign(documents(spark, folder))
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op11_spot_prints(spark: SparkSession, folder: str) -> DataFrame:
    found = spot_prints.fingerprints(documents(spark, folder))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("print")).alias("fingerprint"),
        F.lower(F.hex("edited_print")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


@query
def op12_trie_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_codes.compress(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_repeated_tails(documents(spark, folder))))
