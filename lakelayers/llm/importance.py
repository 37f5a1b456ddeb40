"""Quality classification by importance resampling over hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.common import free, row_numbers, written
from lakelayers.llm.worker import frugal, release

# Bytes of an n-gram and buckets of the hashed models.
GRAM = 4
BUCKETS = 1 << 14
# Labelled documents that the target model is fitted on, at most; a fixed, seeded choice.
FIT_ROWS = 50_000
SMOOTHING = 1.0
SEED = 3
# Bytes that are hashed at once, whatever the length of a text.
SEGMENT = 1 << 20
COUNTED = "bucket int, raw long, target long"


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the UTF-8 bytes, a segment at a time; none for shorter texts."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    for start in range(0, len(raw) - GRAM + 1, SEGMENT):
        part = raw[start : start + SEGMENT + GRAM - 1].astype(np.uint32)
        count = len(part) - GRAM + 1
        code = np.zeros(count, np.uint32)
        for i in range(GRAM):
            code = (code << np.uint32(8)) | part[i : i + count]
        yield ((code * np.uint32(2_654_435_769)) >> np.uint32(32 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def target_sample(labels: DataFrame, rows: int = FIT_ROWS, seed: int = SEED) -> DataFrame:
    """(doc_id) of at most ``rows`` documents labelled good, the same at every run.

    Those with the least seeded hash; of very many, only about twice as many as
    are wanted are put in order.
    """
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) / F.lit(float(1 << 53))
    share = 2 * rows / max(1, good.count())
    return good.where(place < share).orderBy(place, "doc_id").limit(rows)


def log_ratios(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """log(target probability / raw probability) per bucket.

    The raw model counts every n-gram of every document, the target model those
    of the sample. A task adds up its documents and hands on one row per bucket;
    the sums, one row per bucket, come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text, good in zip(batch["text"], batch["good"].to_pylist()):
                for found in grams(text.as_py()):
                    counts = np.bincount(found, minlength=BUCKETS)
                    raw += counts
                    if good:
                        target += counts
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"]
        )

    # The sample is bounded by its parameter: FIT_ROWS ids of eight bytes.
    chosen = F.broadcast(sample.select(F.col("doc_id").alias("_id"), F.lit(True).alias("good")))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marked = slim.join(chosen, F.col("doc_id") == F.col("_id"), "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    sums = marked.mapInArrow(frugal(run), COUNTED).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    for r in sums:
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    if target.sum() == BUCKETS * SMOOTHING:
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_weight(text: Column, ratios: np.ndarray) -> Column:
    """The log importance weight of a text: the sum of its n-grams' log ratios."""

    @F.pandas_udf("double")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([float(sum(ratios[found].sum() for found in grams(t or ""))) for t in texts], dtype="float64")
        release()

    return weigh(F.coalesce(text.cast("string"), F.lit("")))


def gumbel(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise, a function of seed, doc_id and text."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id.cast("long"), text), 11)
    return -F.log(-F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))))


def good_share(labels: DataFrame) -> float:
    """The share of the labelled documents that are good; 1 without labels."""
    found = labels.where("quality is not null").agg(F.avg((F.col("quality") == 1).cast("double")).alias("share")).first()
    return 1.0 if found.share is None else float(found.share)


def scores(docs: DataFrame, ratios: np.ndarray, seed: int = SEED) -> DataFrame:
    """(row, doc_id, log_weight, draw): ``draw`` is the weight with Gumbel noise, written."""
    slim = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        log_weight(F.col("text"), ratios).alias("log_weight"), gumbel(F.col("doc_id"), F.col("text"), seed).alias("noise"),
    )
    return written(slim.select("row", "doc_id", "log_weight", (F.col("log_weight") + F.col("noise")).alias("draw")), "importance")


def ranked(scored: DataFrame) -> DataFrame:
    """Adds ``rank`` from 0, by descending draw; equal draws by doc_id, then row."""
    return row_numbers(scored, [F.col("draw").desc(), F.col("doc_id"), F.col("row")], "importance-order", "rank")


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, fit_rows: int = FIT_ROWS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, log_weight, draw, rank, kept.

    Importance resampling without replacement: the documents with the ``k``
    greatest sums of log weight and Gumbel noise are a sample by weight. ``k``
    is ``share`` of all documents, by default the share of good ones among
    ``labels`` (doc_id, quality), rounded. The weight of a document is the ratio
    of its probabilities under the target and the raw model, both over hashed
    byte n-grams.

    Null text is empty and weighs 1, as do texts shorter than an n-gram. A null
    doc_id is never a target. Without a document labelled good all weights are
    1, and without labels all documents are kept. Repeated rows draw alike and
    rank one after the other. No rows give no rows. Other columns are ignored.
    """
    ratios = log_ratios(docs, target_sample(labels, fit_rows, seed))
    scored = scores(docs, ratios, seed)
    k = round((good_share(labels) if share is None else share) * scored.count())
    return ranked(scored).select("doc_id", "log_weight", "draw", "rank", (F.col("rank") < k).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, share: float | None = None, fit_rows: int = FIT_ROWS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that ``resample`` keeps, with all their columns.

    Rows are weighed again and held against the draw of the last one that is
    kept, so texts are never shuffled; rows that draw exactly like that one
    stay with it.
    """
    ratios = log_ratios(docs, target_sample(labels, fit_rows, seed))
    scored = scores(docs, ratios, seed)
    k = round((good_share(labels) if share is None else share) * scored.count())
    last = ranked(scored).where(F.col("rank") == k - 1).select("draw").first() if k else None
    if last is None:
        return docs.limit(0)
    (draw,) = free(docs, "_draw")
    drawn = docs.withColumn(draw, log_weight(F.col("text"), ratios) + gumbel(F.col("doc_id"), F.col("text"), seed))
    return drawn.where(F.col(draw) >= F.lit(last.draw)).select(*docs.columns)
