"""Periodic runs of words by block convolution at dyadic scales."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A run is at least this many words, and this many times its period, long.
SHORTEST = 6
REPEATS = 4
# Words of a block that are convolved at once; of a longer block its first ones, and extension compares the rest.
ANCHOR = 1 << 12
# Numbers of one batch of transforms.
BATCH = 1 << 18
# Primes below 2**31 that are 1 more than a multiple of 2 * ANCHOR, with a primitive root of each.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
RUNS = "array<struct<start: long, length: long, period: long>>"

Run = tuple[int, int, int]


class Transform:
    """The number-theoretic transform of rows of ``size`` numbers modulo a prime.

    Forth leaves the values in bit-reversed order and back takes them so, which
    a product of two does not mind. Products stay below 2**62.
    """

    def __init__(self, size: int, prime: int, root: int) -> None:
        self.size, self.prime = size, prime
        unit = pow(root, (prime - 1) // size, prime)
        self.turns, self.back_turns = self._powers(unit), self._powers(pow(unit, -1, prime))
        self.share = pow(size, -1, prime)

    def _powers(self, unit: int) -> np.ndarray:
        out = np.ones(max(self.size // 2, 1), np.int64)
        done = 1
        while done < len(out):
            out[done : 2 * done] = out[:done] * pow(unit, done, self.prime) % self.prime
            done *= 2
        return out

    def forth(self, rows: np.ndarray) -> np.ndarray:
        x, length = rows % self.prime, self.size
        while length > 1:
            half = length // 2
            pair = x.reshape(len(x), -1, 2, half)
            low, high = pair[:, :, 0], pair[:, :, 1]
            turn = self.turns[:: self.size // length][:half]
            x = np.stack([(low + high) % self.prime, (low - high + self.prime) * turn % self.prime], axis=2).reshape(len(x), -1)
            length = half
        return x

    def back(self, rows: np.ndarray) -> np.ndarray:
        x, length = rows, 2
        while length <= self.size:
            half = length // 2
            pair = x.reshape(len(x), -1, 2, half)
            low, high = pair[:, :, 0], pair[:, :, 1] * self.back_turns[:: self.size // length][:half] % self.prime
            x = np.stack([(low + high) % self.prime, (low - high + self.prime) % self.prime], axis=2).reshape(len(x), -1)
            length *= 2
        return x * self.share % self.prime


def squared_differences(blocks: np.ndarray, windows: np.ndarray, transform: Transform) -> np.ndarray:
    """Modulo the prime, the sum of squared differences of each block of c words and the
    c words from each of the first c places on of its window of 2c."""
    prime, width = transform.prime, blocks.shape[1]
    turned = np.zeros_like(windows)
    turned[:, :width] = blocks[:, ::-1]
    product = transform.back(transform.forth(windows) * transform.forth(turned) % prime)[:, width - 1 : 2 * width - 1]
    squares = np.zeros((len(windows), 2 * width + 1), np.int64)
    np.cumsum(windows * windows % prime, axis=1, out=squares[:, 1:])
    of_window = (squares[:, width : 2 * width] - squares[:, :width]) % prime
    of_block = (blocks * blocks % prime).sum(axis=1) % prime
    return (of_block[:, None] + of_window - 2 * product) % prime


def _occurrences(words: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) for the distances from ``size`` to twice that at which a block comes again.

    The sum is exact: it is below the product of the primes that are asked, so
    it is zero if and only if it is zero modulo each.
    """
    width = min(size, ANCHOR)
    bound, primes = width * int(words.max()) ** 2, []
    for prime, root in PRIMES:
        primes.append(Transform(2 * width, prime, root))
        bound //= prime
        if not bound:
            break
    # Zero is no word, so nothing matches beyond the end.
    padded = np.concatenate([words, np.zeros(3 * size, np.int64)])
    at_once = max(1, BATCH // (2 * width))
    own, reach = np.arange(width), np.arange(2 * width)
    out_starts, out_distances = [starts[:0]], [starts[:0]]
    for low in range(0, len(starts), at_once):
        some = starts[low : low + at_once]
        blocks = padded[some[:, None] + own]
        for first in range(size, 2 * size, width):
            windows = padded[some[:, None] + first + reach]
            left = np.arange(len(some))
            for transform in primes:
                zero = squared_differences(blocks[left], windows[left], transform) == 0
                if transform is primes[0]:
                    same = zero
                else:
                    same[left] &= zero
                left = np.flatnonzero(same.any(axis=1))
                if not len(left):
                    break
            block, shift = np.nonzero(same)
            out_starts.append(some[block])
            out_distances.append(first + shift)
    return np.concatenate(out_starts), np.concatenate(out_distances)


def _equal_from(left: np.ndarray, right: np.ndarray) -> int:
    """How many values at the beginning of two arrays of one length are equal."""
    done, step = 0, 64
    while done < len(left):
        differs = left[done : done + step] != right[done : done + step]
        if differs.any():
            return done + int(differs.argmax())
        done, step = done + step, 2 * step
    return len(left)


def _covered(runs: list[Run], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether one of the runs holds all words from a start to an end."""
    if not runs:
        return np.zeros(len(starts), bool)
    spans = np.array(sorted((s, s + length) for s, length, _ in runs), np.int64)
    furthest = np.maximum.accumulate(spans[:, 1])
    last = np.searchsorted(spans[:, 0], starts, side="right") - 1
    return (last >= 0) & (furthest[np.maximum(last, 0)] >= ends)


def find_runs(words: np.ndarray) -> list[Run]:
    """(start, length, smallest period) of every run in ``words``, integers from 1 on, by start and period.

    At the scale of B words, periods q from B to 2B - 1 are looked for. A run of
    4q words holds a whole aligned block of B words and its copy q words on, so
    each block is convolved with the window behind it, and each distance at
    which it comes again, without a mismatch, is extended to both sides.

    What cannot give a run is left out before: a block with a word that does not
    come again within 2B words; and what lies within a run of a smaller
    period p, because there a distance d is a multiple of p (two periods of a
    stretch of their sum have their divisor in common), and gives that same run.
    """
    count = len(words)
    found: list[Run] = []
    if count < SHORTEST:
        return found
    order = np.argsort(words, kind="stable")
    again = np.flatnonzero(words[order[1:]] == words[order[:-1]])
    ahead = np.full(count, count, np.int64)
    ahead[order[again]] = order[again + 1] - order[again]
    size, furthest = 1, ahead
    while REPEATS * size <= count:
        starts = np.flatnonzero(furthest < 2 * size) * size
        near = [r for r in found if r[2] <= ANCHOR]
        starts = starts[~_covered(near, starts, starts + 3 * size - 1)]
        if len(starts):
            found += _extended(words, *_occurrences(words, starts, size), min(size, ANCHOR), found, near)
        size *= 2
        whole = len(furthest) // 2
        furthest = furthest[: 2 * whole].reshape(whole, 2).max(axis=1)
    return sorted((s, length, q) for s, length, q in found)


def _extended(
    words: np.ndarray, starts: np.ndarray, distances: np.ndarray, width: int, found: list[Run], near: list[Run]
) -> list[Run]:
    """The runs of this scale: each stretch of words that equal those a distance on, once."""
    open_ = ~_covered(near, starts, starts + width + distances)
    starts, distances = starts[open_], distances[open_]
    order = np.lexsort((starts, distances))
    starts, distances = starts[order], distances[order]
    made, n = [], 0
    while n < len(starts):
        start, distance = int(starts[n]), int(distances[n])
        here, there = words[: len(words) - distance], words[distance:]
        right = start + width + _equal_from(here[start + width :], there[start + width :])
        left = start - _equal_from(here[:start][::-1], there[:start][::-1])
        length = right - left + distance
        if length >= max(SHORTEST, REPEATS * distance):
            made.append((left, length, distance))
        # Blocks of this distance up to the mismatch are in this stretch.
        beyond = int(np.searchsorted(distances, distance, side="right"))
        n += max(1, int(np.searchsorted(starts[n:beyond], right - width, side="right")))
    if not made:
        return made
    held = np.array(made, np.int64)
    smaller = _covered(found, held[:, 0], held[:, 0] + held[:, 1])
    return [r for r, s in zip(made, smaller) if not s]


def word_numbers(words: list[bytes]) -> np.ndarray:
    table: dict[bytes, int] = {}
    return np.array([table.setdefault(w, len(table) + 1) for w in words], np.int64)


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, runs, collapsed.

    Words are what stands between ``[\\x20\\x09-\\x0D]``, numbered from 0. ``runs``
    are (start, length, period) by start and period: a stretch of words with
    smallest period q, at least ``SHORTEST`` words and ``REPEATS`` periods long,
    that no word beside it extends. ``collapsed`` is the text with only the
    first period of each run, its words joined by one space.

    Each text is worked on whole, where it lies, without a shuffle. What is held
    is some hundred bytes a word of one text, and a bounded batch of transforms.
    A null, empty or blank text has no words, no runs and collapses to the empty
    text. Rows with a null or repeated id are rows like all others; no rows give
    no rows. Other columns are ignored.
    """
    schema = f"doc_id long, n_words long, runs {RUNS}, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                counts, runs, texts = [], [], []
                for text in part["text"]:
                    words = text.as_py().split()
                    found = find_runs(word_numbers(words))
                    counts.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                    texts.append(b" ".join(collapsed(words, found)))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(counts, pa.int64()), pa.array(runs, kinds), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, schema)


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the crc32 of the id chooses one text of ten whose words from some place on repeat.

    With h the crc32 of the id as decimals and g = h // 10: in texts with h % 10 = 0, the word i from
    a = g % n on becomes the word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8). Such texts come out with
    their words joined by one space, all others as they are. A null id chooses nothing.
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    code = F.crc32(F.col("doc_id").cast("string"))
    place, period = F.expr("g % n"), F.expr("1 + (n - g % n) div (3 + g % 8)")
    chosen = (
        docs.select("doc_id", "text", code.alias("h"))
        .withColumn("words", F.when(F.expr("h % 10 = 0"), words))
        .withColumns({"n": F.size("words"), "g": F.expr("h div 10")})
    )
    usable = F.coalesce(F.col("n") > 0, F.lit(False))
    chosen = chosen.withColumns({"a": F.when(usable, place), "p": F.when(usable, period)})
    tail = "array_join(transform(sequence(0, n - 1), i -> words[int(if(i < a, i, a + (i - a) % p))]), ' ')"
    return chosen.select("doc_id", F.when(usable, F.expr(tail)).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the longest run, and the digests
    of the runs and of the collapsed text. Of runs of one length the first counts, then the smaller period."""
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    longest: Column = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start as s, -r.period as q)))")
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.s")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.q")).alias("period"), F.expr("(1000 * top.length) div (-top.q)").alias("exponent_milli"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
