"""Hashes of words and of runs of words, as numpy arrays."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np

from lakelayers.llm.pieces import SEGMENT, segments

_BORDER = re.compile(rb"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
# A word is a number in this base, which is odd, so its powers can be divided by; a byte's digit is random.
BASE = 0x9FB21C651E98DF27
_DIGITS = np.random.default_rng(17).integers(0, 1 << 64, 256, np.uint64)
# Bytes of short texts that are worked on together.
TOGETHER = 1 << 18
_SOLID = np.array([b not in b" \t\n\x0b\x0c\r" for b in range(256)], np.int8)


def _powers(base: int, count: int) -> np.ndarray:
    """Powers of ``base`` modulo 2**64, from 0 on, by doubling."""
    out = np.ones(count, np.uint64)
    done = 1
    while done < count:
        out[done : 2 * done] = out[: min(done, count - done)] * np.uint64(pow(base, done, 1 << 64))
        done *= 2
    return out


class _Places:
    """Powers of the base and of its inverse, as many as the longest text so far needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, count: int) -> None:
        if len(self.up) < count:
            count = 1 << (count - 1).bit_length()
            self.up, self.down = _powers(BASE, count), _powers(pow(BASE, -1, 1 << 64), count)


_places = _Places()


def _number(word: bytes) -> int:
    """What ``_words`` gives for one word of any length, a piece at a time."""
    total = 0
    for start in range(0, len(word), SEGMENT):
        digits = _DIGITS[np.frombuffer(word[start : start + SEGMENT], np.uint8)]
        total += int((digits * _places.up[: len(digits)]).sum()) * pow(BASE, start, 1 << 64)
    return total % (1 << 64)


def _words(part: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) of the words of a part: sums of digits times powers, from one running total
    over all its bytes, divided by the power of the place at which the word begins."""
    _places.reach(min(len(part), 2 * SEGMENT))
    if len(part) > 2 * SEGMENT:  # one word, or nearly so
        found = [(m.start(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", part)]
        starts, lengths = np.array([s for s, _ in found], np.int64), np.array([len(w) for _, w in found], np.uint64)
        numbers = np.array([_number(w) for _, w in found], np.uint64)
    else:
        raw = np.frombuffer(part, np.uint8)
        solid = np.zeros(len(raw) + 2, np.int8)
        solid[1:-1] = _SOLID[raw]
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        starts, ends = edges[::2], edges[1::2]
        totals = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_DIGITS[raw] * _places.up[: len(raw)], out=totals[1:])
        numbers = (totals[ends] - totals[starts]) * _places.down[starts]
        lengths = (ends - starts).astype(np.uint64)
    return mix(numbers + lengths * _STEP), starts


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, A-Z lower-cased."""
    parts = [_words(part.lower())[0] for part in segments((text or "").encode("utf-8"), border=_BORDER)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def hashes_of_texts(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """``word_hashes`` of each text; short ones are worked on together."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        if len(text or "") > TOGETHER:
            yield from _together(held)
            held, size = [], 0
            yield word_hashes(text)
            continue
        held.append((text or "").encode("utf-8"))
        size += len(held[-1])
        if size > TOGETHER:
            yield from _together(held)
            held, size = [], 0
    yield from _together(held)


def _together(texts: list[bytes]) -> list[np.ndarray]:
    if not texts:
        return []
    found, starts = _words(b" ".join(texts).lower())
    ends = np.cumsum([len(t) + 1 for t in texts])[:-1]
    return np.split(found, np.searchsorted(starts, ends))


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX1
    values = (values ^ (values >> np.uint64(27))) * _MIX2
    return values ^ (values >> np.uint64(31))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, in order; none if there are fewer words.

    Runs are put together from runs of half the length, so a run costs as many
    steps as its length has binary digits, and one more for each odd half.
    """
    if len(words) < length:
        return np.empty(0, np.uint64)
    first = mix(words * _STEP + np.uint64(length))
    out, run = first, 1
    for digit in f"{length:b}"[1:]:
        out = mix(out[:-run] * _STEP + out[run:])
        run *= 2
        if digit == "1":
            out = mix(out[: len(words) - run] * _STEP + first[run:])
            run += 1
    return out


def shingles(text: str | None, length: int) -> np.ndarray:
    """The distinct shingles of a text, sorted: runs of ``length`` words, or all words if fewer."""
    return shingles_of(word_hashes(text), length)


def shingles_of(words: np.ndarray, length: int) -> np.ndarray:
    return np.unique(run_hashes(words, min(length, len(words)))) if len(words) else words
