"""Document fingerprints from spot signatures: chains of content words behind common words."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakelayers.llm.common import written
from lakelayers.llm.worker import frugal

# Common words behind which a signature begins: articles and forms of "to be".
ANCHORS = frozenset(
    "the a an is was that "
    "der die das ein eine ist "
    "le la les un une est "
    "el los las una es".split()
)
# Content words of a chain.
CHAIN = 2
# Words to each side without a common word, from which on a word may begin a signature by itself.
BARE = 12
# Less than this counts as no likeness.
FLOOR = 0.05
# Signatures that are compared between two looks at whether the floor can still be reached.
STEP = 256
WORD = re.compile(r"\w+")
PRINT = np.dtype(">u4")

COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, print binary, edited_print binary, near_edited double, near_next double"
)
# Rows that are not whole yet: the first text of a task (0), and the last, whose next one another task holds (2).
PASSED = f"kind int, part int, text binary, {COMPARED}"
HEAD, WHOLE, OPEN = 0, 1, 2


def signatures(text: str, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN, bare: int = BARE) -> np.ndarray:
    """The ascending, distinct signatures of a text, as 32-bit hashes.

    A signature is a common word with the ``chain`` content words that follow
    it, or with as many as there are. Where no common word is within ``bare``
    words to either side, each word begins one, so junk, lists and languages
    without anchors have signatures as well. A text without letters or digits
    is taken by what stands between its blanks; a blank text has none.
    """
    words = WORD.findall(text.lower()) or text.split()
    count = len(words)
    if not count:
        return np.zeros(0, np.uint32)
    common = np.fromiter(map(anchors.__contains__, words), bool, count)
    before = np.concatenate([[0], np.cumsum(common)])
    place = np.arange(count)
    alone = before[np.minimum(place + bare + 1, count)] == before[np.maximum(place - bare, 0)]
    spots = np.flatnonzero(common | alone)
    content = np.flatnonzero(~common)
    behind = np.searchsorted(content, spots, side="right")
    content = content.tolist()
    chains = {
        " ".join([words[s], *[words[c] for c in content[b : b + chain]]]) for s, b in zip(spots.tolist(), behind.tolist())
    }
    return np.unique(np.array([xxhash.xxh32_intdigest(c) for c in chains], np.uint32))


def length_part(size: int, floor: float) -> int:
    """The partition of sets of a size: sets of partitions that are not the same or side by side cannot reach the floor."""
    return int(math.log(size) / -math.log(floor)) if size else -1


def likeness(left: np.ndarray, right: np.ndarray, floor: float = FLOOR) -> float:
    """Jaccard similarity of two ascending sets, 0 below ``floor``; equal sets, two empty ones too, have 1.

    Sets whose length partitions lie apart are not compared at all, nor are
    sets of which the smaller is too small. Others are merged by steps until
    what is left of the smaller one cannot make up the overlap that is needed.
    """
    if len(left) == len(right) and np.array_equal(left, right):
        return 1.0
    small, large = sorted((left, right), key=len)
    if abs(length_part(len(small), floor) - length_part(len(large), floor)) > 1 or len(small) < floor * len(large):
        return 0.0
    total, shared = len(small) + len(large), 0
    needed = floor * total / (1 + floor)
    for start in range(0, len(small), STEP):
        if shared + len(small) - start < needed:
            return 0.0
        piece = small[start : start + STEP]
        at = np.minimum(np.searchsorted(large, piece), len(large) - 1)
        shared += int((large[at] == piece).sum())
    found = shared / (total - shared)
    return found if found >= floor else 0.0


def edited(text: str, other: str) -> str:
    """``text`` with its last third replaced by as many first characters of ``other``, or all."""
    third = len(text) // 3
    return text[: len(text) - third] + other[:third]


class _Comparison:
    """A text and its signatures, compared with the next one."""

    def __init__(self, doc_id: int | None, raw: bytes) -> None:
        self.doc_id, self.raw = doc_id, raw
        self.text = raw.decode("utf-8", "replace")
        self.print = signatures(self.text)

    def row(self, following: _Comparison) -> tuple:
        changed = edited(self.text, following.text)
        other = self.print if changed == self.text else signatures(changed)
        return (
            self.doc_id, len(self.text), hashlib.sha256(changed.encode()).hexdigest(), packed(self.print), packed(other),
            likeness(self.print, other), likeness(self.print, following.print),
        )


def packed(found: np.ndarray) -> bytes:
    return found.astype(PRINT).tobytes()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor().compress
    for batch in batches:
        texts = pa.array([squeeze(t.as_py()) for t in batch["text"]], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("text"), "text", texts)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    names = [f.split()[0] for f in PASSED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row of a sorted task with the one after it."""
    last: _Comparison | None = None
    part, blank, unpack = 0, (None,) * 7, zstandard.ZstdDecompressor().decompress
    for batch in batches:
        rows = []
        for doc_id, text, part in zip(batch["doc_id"].to_pylist(), batch["text"], batch["part"].to_pylist()):
            now = _Comparison(doc_id, unpack(text.as_py()))
            rows.append((HEAD, part, now.raw, *blank) if last is None else (WHOLE, part, None, *last.row(now)))
            last = now
        yield _batch(rows)
    if last is not None:
        yield _batch([(OPEN, part, last.raw, last.doc_id, *blank[1:])])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the last row of a task with the first one of the next."""
    for batch in batches:
        for n in range(batch.num_rows):
            row = batch.slice(n, 1)
            now, following = (_Comparison(row["doc_id"][0].as_py(), row[c][0].as_py()) for c in ("text", "following"))
            yield _batch([(WHOLE, 0, None, *now.row(following))])


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``COMPARED``.

    ``print`` holds the signatures of the text, and ``edited_print`` those of
    the text whose last third is replaced by as many first characters of the
    next text, in descending order of ids; the first text comes after the last.
    ``near_edited`` and ``near_next`` are the likeness of the text to its edited
    text and to the next one, 0 below ``FLOOR``. Equal texts have equal prints.

    The texts are dealt by ranges of their ids and compared as they stream by,
    so each crosses the network once, compressed. The last row of a task waits for the
    first of the next: one row per task, which a small second pass compares.

    A null text counts as empty. Blank texts have no signatures; they are like
    each other and nothing else. Null ids come last. Rows with one id are
    ordered by a hash of their texts, equal ones by their place in the table. A
    text that is the only one is its own next. Whole texts are taken, one at a
    time, however long. What is no valid UTF-8 is read with marks in place of
    it. No rows give no rows. Other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    order = [F.col("doc_id").desc_nulls_last(), "tie", "place"]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"), F.xxhash64(text).alias("tie"),
        F.monotonically_increasing_id().alias("place"),
    )
    dealt = (
        rows.mapInArrow(frugal(_pack), rows.schema)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    passed = written(dealt.mapInArrow(frugal(_pass), PASSED), "spot-prints")
    heads = passed.where(F.col("kind") == HEAD).select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    # One row per task of the pass, without its text.
    parts = heads.select(F.col("next_part").alias("part"))
    in_order = Window.orderBy("part")
    first = F.min("part").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    parts = parts.select("part", F.coalesce(F.lead("part").over(in_order), first).alias("next_part"))
    waiting = passed.where(F.col("kind") == OPEN).select("part", "doc_id", "text").join(parts, "part").join(heads, "next_part")
    closed = waiting.select("doc_id", "text", "following").mapInArrow(_close, PASSED)
    columns = [f.split()[0] for f in COMPARED.split(", ")]
    return passed.where(F.col("kind") == WHOLE).select(*columns).unionByName(closed.select(*columns))
