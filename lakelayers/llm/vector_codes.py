"""Vector code compression: product codes whose distances are shared along a trie of parts."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.common import written

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Leaves of the trie that are worked on at once: bounds memory at any size of a task.
LEAVES = 8192
SUMS = "part int, entry int, rows long, sums array<long>"
# (part, entry, position within the part) -> component
Codebooks = list[np.ndarray]


class Trie:
    """Depth-first walk over distinct vectors in lexicographic order, a slice of leaves at a time.

    A node is a distinct prefix, and holds the distance of that prefix to the
    prefix of every entry. Vectors in lexicographic order are the leaves from
    left to right; a node's row of distances is made once, from its parent's,
    for all leaves below it. The open path is kept from slice to slice, so a
    prefix that goes over the border of a slice is not computed again.
    """

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.last: np.ndarray | None = None
        self.path = np.zeros((entries.shape[1], len(entries)), np.int64)

    def distances(self, leaves: np.ndarray) -> np.ndarray:
        """Squared distance of each leaf to each entry; no two leaves in a row are equal."""
        count, depth = leaves.shape
        if not count or not depth:
            return np.zeros((count, len(self.entries)), np.int64)
        before = np.vstack([leaves[:1] if self.last is None else self.last[None], leaves[:-1]])
        differs = before != leaves
        # The depth at which a leaf leaves the path of the one before it.
        branch = np.where(differs.any(axis=1), differs.argmax(axis=1), depth)
        if self.last is None:
            branch[0] = 0
        above, of_leaf = np.zeros((1, len(self.entries)), np.int64), np.zeros(count, np.int64)
        for d in range(depth):
            new = branch <= d
            gap = leaves[new, d][:, None] - self.entries[:, d]
            above = np.vstack([self.path[d], above[of_leaf[new]] + gap * gap])
            of_leaf = np.cumsum(new)
            self.path[d] = above[-1]
        self.last = leaves[-1].copy()
        return above[of_leaf]


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _sums(parts: DataFrame, books: Codebooks) -> DataFrame:
    """``SUMS``: per task, the sum and number of the vectors nearest to each entry."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[int, Trie] = {}
        totals: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, LEAVES):
                piece = batch.slice(start, LEAVES)
                number, rows = piece["part"].to_numpy(), piece["rows"].to_numpy()
                values = _lists(piece["vector"], width)
                for p in np.unique(number).tolist():
                    here = number == p
                    leaves, weight = values[here], rows[here]
                    if p not in tries:
                        tries[p] = Trie(books[p])
                        totals[p] = np.zeros(len(books[p]), np.int64), np.zeros_like(books[p])
                    nearest = tries[p].distances(leaves).argmin(axis=1)
                    held, sums = totals[p]
                    for e in np.unique(nearest):
                        mine = nearest == e
                        held[e] += weight[mine].sum()
                        sums[e] += weight[mine] @ leaves[mine]
        out = [(p, e, int(held[e]), sums[e].tolist()) for p, (held, sums) in totals.items() for e in np.flatnonzero(held).tolist()]
        if out:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "rows", "sums"])

    return parts.mapInArrow(run, SUMS)


def _moved(parts: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round: each entry is the mean of its vectors, rounded down.

    What comes to the driver is one number per component of the codebooks.
    """
    exact = "decimal(38,0)"
    found = (
        _sums(parts, books)
        .select("part", "entry", "rows", F.posexplode("sums").alias("place", "value"))
        .groupBy("part", "entry", "place")
        .agg(F.sum(F.col("rows").cast(exact)).alias("rows"), F.sum(F.col("value").cast(exact)).alias("value"))
        .collect()
    )
    books = [b.copy() for b in books]
    for r in found:
        books[r.part][r.entry, r.place] = int(r.value) // int(r.rows)
    return books


def _coded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """Adds the code and its error; the trie is over the distinct parts of a slice of rows."""
    width = books[0].shape[1]
    schema = vectors.drop("vector").schema.add("code", "string").add("error", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, LEAVES):
                piece = batch.slice(start, LEAVES)
                values = _lists(piece["vector"], width * PARTS)
                codes = np.zeros((piece.num_rows, PARTS), np.uint8)
                error = np.zeros(piece.num_rows, np.int64)
                for p, book in enumerate(books):
                    if not width:
                        continue
                    leaves, of_row = np.unique(values[:, p * width : (p + 1) * width], axis=0, return_inverse=True)
                    apart = Trie(book).distances(leaves)
                    nearest, of_row = apart.argmin(axis=1), of_row.reshape(-1)
                    codes[:, p] = nearest[of_row]
                    error += apart[np.arange(len(leaves)), nearest][of_row]
                kept = [piece.column(i) for i, n in enumerate(piece.schema.names) if n != "vector"]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)], names=schema.names
                )

    return vectors.mapInArrow(run, schema)


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id, label and the usable vectors as integers, filled up to one width with zeros."""
    value = F.col("embedding").cast("array<double>")
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", value.alias("embedding")).where(
        "embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) <> double('infinity'))"
    )
    longest = usable.agg(F.max(F.size("embedding"))).first()[0] or 0
    size = math.ceil(longest / PARTS) * PARTS
    # The squared distance of two vectors within this bound fits 64 bits.
    bound = math.isqrt((1 << 62) // max(size, 1)) // 2
    whole = f"transform(embedding, x -> cast(floor(greatest(least({SCALE}D * x, {bound}D), -{bound}D)) as bigint))"
    filled = f"concat({whole}, array_repeat(0L, {size} - size(embedding)))" if size else "cast(array() as array<bigint>)"
    return usable.select("vec_id", "label", F.expr(filled).alias("vector"))


def compress(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per usable row of ``vectors`` (vec_id, embedding, label): vec_id, label, code, error, label_error, codebooks_sha256.

    Components become integers, vectors are cut into ``PARTS`` consecutive
    parts, and each part is replaced by the number of the nearest entry of its
    codebook. A codebook starts as the parts of the smallest ``vec_id`` and
    takes ``rounds`` rounds of moving its entries to the mean of what is
    nearest to them. All numbers are integers, so no result depends on the
    order of tasks.

    The distinct parts of the whole table are counted once and kept in
    lexicographic order, split by ranges: a part that a third of all rows holds
    is one row with a count. Each round is one pass over them, a trie per task,
    and brings a number per component of the codebooks to the driver. The codes
    come from a pass over the vectors themselves, without a shuffle.

    A vector that is null or holds a null, NaN or infinite component has no row.
    One that is shorter than the longest counts as filled up with zeros, and so
    does an empty one. Components so large that a squared distance might not fit
    64 bits (beyond 2**30 / sqrt(dimensions) before scaling by 4096 at the
    least) count as the largest that do. A sum of errors beyond 64 bits is null.
    Null ids come after all others; rows with one id are ordered by their
    vectors. Repeated rows count each. No usable rows give no rows. Other
    columns are ignored.
    """
    held = whole_numbers(vectors)
    first = held.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    width = len(first[0].vector) // PARTS if first else 0
    books = [
        np.array([r.vector[p * width : (p + 1) * width] for r in first], np.int64).reshape(len(first), width) for p in range(PARTS)
    ]
    if width:
        cut = F.array(*[F.slice("vector", p * width + 1, width) for p in range(PARTS)])
        parts = held.select(F.posexplode(cut).alias("part", "vector")).groupBy("part", "vector").agg(F.count("*").alias("rows"))
        parts = written(parts.repartitionByRange("part", "vector").sortWithinPartitions("part", "vector"), "vector-parts")
        for _ in range(rounds):
            books = _moved(parts, books)
    told = ",".join(str(x) for book in books for x in book.ravel().tolist())
    coded = written(_coded(held, books), "vector-codes")
    errors = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    return coded.join(errors, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "label", "code", "error", F.expr("try_cast(total as bigint)").alias("label_error"),
        F.lit(hashlib.sha256(told.encode()).hexdigest()).alias("codebooks_sha256"),
    )
