"""Byte-level BPE encoding and decoding over Arrow batches."""

from __future__ import annotations

import base64
import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.pieces import LETTERS, PUNCTUATION, PieceMemory, byte_characters, packed, segments, shown
from lakelayers.llm.worker import frugal

BATCH_ROWS = 128
# Distinct pieces, and matches in them, that a worker keeps.
REMEMBERED = 1 << 17
# Each piece starts at white space that follows something else: there the
# splitting pattern always starts a new match, so pieces can be encoded alone.
_PIECE = re.compile(r"\s*\S+|\s+")
# White space to Python's patterns, but not to the tokenizer's.
_ODD = re.compile(r"[\x1c-\x1f]")
# A piece that is one match of letters and maybe one of punctuation.
_PLAIN = re.compile(rf"( ?[{LETTERS}]+)([{PUNCTUATION}]*)")


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The merges behind the ranks: each token's last pair when only lower ranks may merge."""
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min((ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best >= rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            merges.append((parts[0], parts[1]))
    return merges


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class ByteBPE:
    """Encoder and decoder for a file of ranks and a splitting pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks, marks = read_ranks(path), byte_characters()

        def written(token: bytes) -> str:
            return "".join(marks[b] for b in token)

        vocabulary = {written(token): rank for token, rank in ranks.items()}
        merges = [(written(a), written(b)) for a, b in merges_of(ranks)]
        # A match that is a token itself takes its id at once, whatever the merges say.
        self.tokenizer = Tokenizer(models.BPE(vocabulary, merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        byte_of = {c: b for b, c in enumerate(marks)}
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in vocabulary.items():
            self.bytes_of[rank] = bytes(byte_of[c] for c in token)
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.decimals = [str(i) for i in range(len(self.bytes_of))]
        self.matches = PieceMemory(self._match, REMEMBERED)
        self.memory = PieceMemory(self._piece, REMEMBERED)

    def _match(self, match: str) -> bytes:
        return packed([t.id for t in self.tokenizer.model.tokenize(shown(match))])

    def _piece(self, piece: str) -> bytes:
        """Plain pieces go straight to the model, match by match; the rest through the whole tokenizer."""
        if plain := _PLAIN.fullmatch(piece):
            word, mark = plain.groups()
            return self.matches[word] + self.matches[mark] if mark else self.matches[word]
        return packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        if _ODD.search(text):
            return np.frombuffer(self._piece(text), "<u4")
        parts = [b"".join(map(self.memory.__getitem__, _PIECE.findall(part))) for part in segments(text)]
        return np.frombuffer(b"".join(parts), "<u4")

    def shown(self, ids: list[int]) -> str:
        """Ids as decimals joined by a space."""
        return " ".join(map(self.decimals.__getitem__, ids))

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The text of ids. Characters split over tokens come together, because bytes are
        joined first; what is cut at either end becomes the replacement character."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def offsets(self, ids: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each token in ``text``, in code points, end exclusive.

        A token that holds part of a character spans that whole character.
        """
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        begun = np.cumsum((raw & 0xC0) != 0x80)  # characters that have begun at each byte
        return begun[starts] - 1 if len(ids) else starts, begun[ends - 1] if len(ids) else ends


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(path, pattern)


ENCODED = (
    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean, offsets_crc32 long, "
    "ids array<int>, starts array<int>, ends array<int>"
)


def encode_documents(docs: DataFrame, ranks: str, pattern: str, ids: bool = True, offsets: bool = True) -> DataFrame:
    """One row per row of ``docs``, in no order: ``ENCODED``.

    Whole texts; null text is empty, has no tokens, and decodes to nothing.
    ``decoded_sha256`` is of the bytes that the ids decode to, ``same`` says
    whether these are the text's, ``offsets_crc32`` is of all starts and then all
    ends as little-endian 32-bit integers. ``ids``, ``starts`` and ``ends`` (code
    points) are null unless asked for. Repeated rows give repeated results, no rows give
    none, and other columns are ignored. One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(ranks, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                texts = part["text"].to_pylist()
                out: list[list] = [[] for _ in kinds]
                for text in texts:
                    found = bpe.encode(text)
                    listed = found.tolist()
                    raw = bpe.decode_bytes(listed)
                    spans = [side.astype("<i4") for side in bpe.offsets(found, text)]
                    for column, value in zip(out, (
                        len(found), hashlib.sha256(bpe.shown(listed).encode()).hexdigest(), hashlib.sha256(raw).hexdigest(),
                        raw == text.encode("utf-8"), zlib.crc32(b"".join(side.tobytes() for side in spans)),
                        found if ids else None, *(spans if offsets else (None, None)),
                    )):
                        column.append(value)
                arrays = [part["doc_id"], *(pa.array(c, k) for c, k in zip(out, kinds))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = [c.split()[0] for c in ENCODED.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int64(), *[pa.list_(pa.int32())] * 3]
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).mapInArrow(frugal(run), ENCODED)
