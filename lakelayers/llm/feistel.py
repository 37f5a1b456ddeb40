"""Sharding by a keyed permutation of global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.common import row_numbers, written

SHARDS = 16
SEED = 20_240_601
ROUNDS = 6
_MULTIPLIER = np.uint64(1_640_531_513)
_LOW32 = np.uint64(0xFFFFFFFF)


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """32-bit keys, one a round, by a multiplicative generator."""
    keys, state = [], seed & 0x7FFFFFFF
    for _ in range(rounds):
        state = (state * 1_103_515_245 + 12_345) % (1 << 31)
        keys.append(state)
    return keys


def half_bits(rows: int) -> int:
    """Half the width of the smallest even-bit domain that holds ``rows`` numbers."""
    return max(1, (max(rows - 1, 1).bit_length() + 1) // 2)


def permute(numbers: np.ndarray, rows: int, seed: int = SEED) -> np.ndarray:
    """A permutation of 0 .. rows-1, applied to ``numbers``.

    A balanced Feistel network permutes the next power of four; a number that
    leaves the range is sent through again until it is back (cycle walking).
    The domain is less than four times the range, so few walk far.
    """
    half = np.uint64(half_bits(rows))
    mask = np.uint64((1 << int(half)) - 1)
    keys = [np.uint64(k) for k in round_keys(seed)]
    out = np.asarray(numbers).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for key in keys:
            mixed = ((right ^ key) * _MULTIPLIER) & _LOW32
            mixed = ((mixed ^ (mixed >> np.uint64(15))) * _MULTIPLIER) & _LOW32
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(13))) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(rows)]
    return out.astype(np.int64)


def locate(row_number: int, rows: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of a row number, without any table."""
    place = int(permute(np.array([row_number]), rows, seed)[0])
    return place % shards, place // shards


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number.

    Law ``rows``: numbers count rows by ascending doc_id (null first; equal ids
    by checksum and size), the permuted number modulo ``shards`` is the shard
    and its quotient the slot, so shards differ by one row at most. Groups of
    equal texts are dealt out like all rows. Null text has size 1 and checksum
    0, as empty text. Repeated rows get places of their own. An empty table
    gives an empty result. Other columns of ``docs`` are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).cast("long").alias("text_crc32"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "shard-rows",
    )
    rows = slim.count()

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), rows, seed))

    return (
        row_numbers(slim, ["doc_id", "text_crc32", "size", "_row"], "shard-order")
        .withColumn("_place", place("row_number"))
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
            (F.col("_place") % shards).cast("int").alias("shard"),
            F.floor(F.col("_place") / shards).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "row_number",
        )
    )
