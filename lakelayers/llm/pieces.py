"""Encoding by pieces between white space, with a bounded memory of pieces seen."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

# Distinct pieces kept by one task, in each of two generations, and the longest piece worth keeping.
REMEMBERED = 1 << 18
LONGEST = 64
# Characters of a text that are split at once: bounds the memory of a very long text.
SEGMENT = 1 << 20
_BORDER = re.compile(r"(?<=\S)(?=\s)")
# Letters below U+0180, but for one whose lower case is two characters. They are letters to
# every pattern and in composed form, so a run of them, and a run of this punctuation after
# it, are matches of their own to the tokenizers' splits.
LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
PUNCTUATION = ".,;:!?"


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable
    Latin-1 for itself, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    table.update((b, chr(256 + n)) for n, b in enumerate(b for b in range(256) if b not in table))
    return [table[b] for b in range(256)]


_SHOWN = dict(enumerate(byte_characters()))


def shown(word: str) -> str:
    """A word as the characters of its bytes."""
    return word if word.isascii() and " " not in word else word.encode("utf-8").decode("latin-1").translate(_SHOWN)


def packed(ids: list[int]) -> bytes:
    """Ids as unsigned 32-bit integers, in the byte order of every machine that Spark runs on: little-endian."""
    return array("I", ids).tobytes()


class PieceMemory(dict):
    """The ids of pieces; looks up what is known and computes the rest.

    Two generations: when the young one is full it becomes the old one, and
    what is used of the old one moves back. So frequent pieces stay, and memory
    stays bounded whatever the corpus holds.
    """

    def __init__(self, compute: Callable[[str], bytes], limit: int = REMEMBERED) -> None:
        super().__init__()
        self.compute, self.limit = compute, limit
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        value = self.old.get(piece)
        if value is None:
            value = self.compute(piece)
        if len(piece) <= LONGEST:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[piece] = value
        return value


def segments(text, size: int = SEGMENT, border: re.Pattern = _BORDER) -> Iterator:
    """The text in parts that end before white space which follows something else."""
    start = 0
    while len(text) - start > size:
        found = border.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text
