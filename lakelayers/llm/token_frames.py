"""Token ids as files of independent zstandard frames with a trailing seek table.

A file is a row of zstandard frames, each with the little-endian unsigned 32-bit
ids of one document or part of one; then a skippable frame with the document
index (an Arrow stream: doc_id, n_tokens, first_frame), and last a skippable
frame with the seek table of the public seekable format: for each frame its
compressed size, its size, and the low 32 bits of the XXH64 of its content. Any
zstandard reader reads such a file; one that knows the table fetches only the
frames it is asked for.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.llm.common import running_total, written
from lakelayers.llm.pieces import LETTERS, PUNCTUATION, PieceMemory, packed, segments, shown
from lakelayers.session import scratch_dir

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
INDEX_FRAME = 0x184D2A50
SEEKABLE = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

# A piece of letters and maybe punctuation.
_PLAIN = re.compile(rf"([{LETTERS}]+)([{PUNCTUATION}]*)")

END_ID = 2
LEVEL = 1
# Ids in one frame; a longer document takes several, so memory is bounded on both sides.
FRAME_IDS = 1 << 20
# Texts that are split and looked up together.
BATCH_ROWS = 128
MANIFEST = "file_no int, file string, n_docs long, n_ids long"
FOUND = "doc_id long, before long, n_tokens long, ids_crc32 long, file_no int, nth long, first_frame long, frames long"


def storage(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    return arrow_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (arrow_fs.LocalFileSystem(), path)


class FrameWriter:
    def __init__(self, sink, level: int = LEVEL) -> None:
        self.sink = sink
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.table: list[bytes] = []
        self.frames = 0
        self.ids, self.counts, self.first = [], [], []

    def document(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.first.append(self.frames)
        for start in range(0, len(ids), FRAME_IDS * 4):
            self._frame(ids[start : start + FRAME_IDS * 4])

    def _frame(self, content: bytes) -> None:
        packed = self.compressor.compress(content)
        self.sink.write(packed)
        self.table.append(struct.pack("<III", len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.frames += 1

    def close(self) -> None:
        index = pa.table({
            "doc_id": pa.array(self.ids, pa.int64()), "n_tokens": pa.array(self.counts, pa.int64()),
            "first_frame": pa.array(self.first, pa.int64()),
        })
        buffer = pa.BufferOutputStream()
        with pa.ipc.new_stream(buffer, index.schema) as stream:
            stream.write_table(index)
        content = buffer.getvalue().to_pybytes()
        self.sink.write(struct.pack("<II", INDEX_FRAME, len(content)) + content)
        self.table.append(struct.pack("<III", len(content) + 8, 0, 0))
        entries = b"".join(self.table)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries)
        self.sink.write(struct.pack("<IBI", len(self.table), HAS_CHECKSUMS, SEEKABLE))


class FrameReader:
    """Reads the table and the index, then only the frames asked for."""

    def __init__(self, source, size: int) -> None:
        self.source = source
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or not flags & HAS_CHECKSUMS:
            raise ValueError("not a file of frames with checksums")
        entries = self._at(size - 9 - 12 * count, 12 * count)
        self.table = np.frombuffer(entries, "<u4").reshape(-1, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        start = int(self.offsets[count - 1])
        index = pa.ipc.open_stream(self._at(start + 8, int(self.table[-1, 0]) - 8)).read_all()
        self.doc_ids = index["doc_id"].to_pylist()
        self.counts = index["n_tokens"].to_numpy()
        self.first = index["first_frame"].to_numpy()
        self.decompressor = zstandard.ZstdDecompressor()

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        found = self.source.read(size)
        if len(found) != size:
            raise ValueError("file is cut short")
        return found

    def frames_of(self, nth: int) -> range:
        last = len(self.table) - 1 if nth + 1 == len(self.first) else int(self.first[nth + 1])
        return range(int(self.first[nth]), last)

    def parts(self, nth: int) -> Iterator[bytes]:
        """The checked contents of the nth document's frames."""
        for frame in self.frames_of(nth):
            size, full, check = (int(v) for v in self.table[frame])
            content = self.decompressor.decompress(self._at(int(self.offsets[frame]), size), max_output_size=full)
            if len(content) != full or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {frame} is damaged")
            yield content

    def document(self, nth: int) -> np.ndarray:
        return np.frombuffer(b"".join(self.parts(nth)), "<u4")


@lru_cache(maxsize=1)
def word_memory(path: str) -> PieceMemory:
    """Ids of the pieces between white space, which the tokenizer's own split never crosses."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True

    model = tokenizer.model

    def match(found: str) -> bytes:
        return packed([t.id for t in model.tokenize(shown(found))])

    words = PieceMemory(match)

    def encode(piece: str) -> bytes:
        # Plain words go straight to the model, lower-cased as the tokenizer would; the rest through all of it.
        if plain := _PLAIN.fullmatch(piece):
            word, mark = plain.groups()
            return words[word.lower()] + words[mark] if mark else words[word.lower()]
        return packed(tokenizer.encode(piece, add_special_tokens=False).ids)

    return PieceMemory(encode)


def _split(text: str) -> list[str]:
    # str.split also splits at the four separators 1C to 1F, which are no white space to the tokenizer.
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [p for p in text.replace("\n", " ").replace("\t", " ").split(" ") if p]
    return (text.lower() if text.isascii() else text).split()


def encode_texts(texts: list[str], memory: PieceMemory, end: int | None = END_ID) -> Iterator[bytes]:
    """The ids of each text, little-endian, with ``end`` appended."""
    tail = b"" if end is None else struct.pack("<I", end)
    for text in texts:
        yield b"".join([*[b"".join(map(memory.__getitem__, _split(part))) for part in segments(text)], tail])


@dataclass
class TokenFiles:
    """Written files: their manifest (file_no, file, n_docs, n_ids, first_id) in doc_id order."""

    spark: SparkSession
    manifest: DataFrame
    folder: str = field(default="")

    def read(self) -> DataFrame:
        """One row per document: doc_id, start, n_tokens, ids_crc32, file, nth, first_frame, frames."""
        files = max(1, self.manifest.count())

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for no, path in zip(batch["file_no"].to_pylist(), batch["file"].to_pylist()):
                    system, inner = storage(path)
                    with system.open_input_file(inner) as source:
                        reader = FrameReader(source, source.size())
                        before, rows = 0, []
                        for nth, doc_id in enumerate(reader.doc_ids):
                            check = size = 0
                            for part in reader.parts(nth):
                                check = zlib.crc32(part, check)
                                size += len(part) // 4
                            frames = reader.frames_of(nth)
                            rows.append((doc_id, before, size, check, no, nth, frames.start, len(frames)))
                            before += size
                            if len(rows) == 10_000:
                                yield _batch(rows)
                                rows = []
                        yield _batch(rows)

        found = self.manifest.select("file_no", "file").repartition(files).mapInArrow(scan, FOUND)
        starts = self.manifest.select("file_no", "file", "first_id")
        return found.join(starts, "file_no").select(
            "doc_id", (F.col("first_id") + F.col("before")).alias("start"), "n_tokens", "ids_crc32",
            "file", "nth", "first_frame", "frames",
        )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in FOUND.split(", ")]
    kinds = [pa.int32() if c.split()[1] == "int" else pa.int64() for c in FOUND.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(v), k) for v, k in zip(zip(*rows) if rows else [()] * len(names), kinds)], names=names
    )


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, end: int | None = END_ID) -> TokenFiles:
    """Encodes whole texts and writes them in ascending doc_id order (null first).

    Documents are dealt out by ranges of doc_id and each task writes one file,
    text for text, under a name of its own; only the files of tasks that count
    get into the manifest, so repeated or lost tasks do no harm. Null text is
    empty: its ids are the end id alone. Rows that repeat a doc_id follow each
    other, ordered by text hash. No rows give an empty manifest. Other columns
    are ignored. ``folder`` must be on storage that all executors share.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "token-files")
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("twin"))
    ordered = slim.repartitionByRange("doc_id", "twin").sortWithinPartitions("doc_id", "twin").select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memory, writer, sink, path, total = word_memory(tokenizer), None, None, "", 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                piece = batch.slice(start, BATCH_ROWS)
                if writer is None:
                    path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex[:8]}.tok.zst"
                    system, inner = storage(path)
                    system.create_dir(os.path.dirname(inner), recursive=True)
                    sink = system.open_output_stream(inner, compression=None)
                    writer = FrameWriter(sink)
                for doc_id, ids in zip(piece["doc_id"].to_pylist(), encode_texts(piece["text"].to_pylist(), memory, end)):
                    writer.document(doc_id, ids)
                    total += len(ids) // 4
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([path]), pa.array([len(writer.ids)], pa.int64()), pa.array([total], pa.int64())],
                names=["file_no", "file", "n_docs", "n_ids"],
            )

    files = written(ordered.mapInArrow(encode, MANIFEST), "token-manifest")
    return TokenFiles(spark, written(running_total(files, "file_no", "n_ids", "first_id"), "token-starts"), folder)
