"""A corpus pipeline: quality, exact copies, near copies, mixture, token ids."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakelayers.llm import bytebpe, digest_index, importance, minhash, mixing
from lakelayers.llm.common import documents, written
from lakelayers.llm.queries import reachable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the importance sample leaves out; the labels beside the documents are the target.

    Null text is empty. Of equal draws the smaller doc_id comes first, and rows that repeat are drawn
    each. Without labels nothing is dropped; no rows give none.
    """
    reachable(spark)
    return importance.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text, by digest without white space: the one with most code points,
    then the smallest doc_id. Null and blank texts are one text. Of rows that repeat one stays; no rows give none."""
    return digest_index.distinct_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by shingles of five words at a similarity of 0.8: the
    one with the smallest doc_id. Texts without words are linked with nothing. Rows that repeat a
    doc_id stay or go together; no rows give none."""
    reachable(spark)
    return minhash.distinct_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that sources come to their target weights. A null source is a
    source, a null text has no words and is never needed; rows that repeat count each; no rows give none."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and digests of the ids, of what they decode to and of their offsets, one row
    per row. Null text is empty and has no ids; rows that repeat are encoded each; no rows give none."""
    reachable(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bytebpe.encode_documents(docs, path, public_tokenizers.PATTERN, offsets=False)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "offsets_crc32", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("token_ids", token_ids),
]

# The model weights, signatures and merges of the stages are nothing SQL can say;
# tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each over what the one before wrote."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
