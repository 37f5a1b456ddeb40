"""MinHash near-duplicates with sequential Bayesian verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.common import components, free, written
from lakelayers.llm.wordhash import hashes_of_texts, shingles_of
from lakelayers.llm.worker import frugal

SHINGLE_WORDS = 5
THRESHOLD = (80, 100)
BAND_ROWS = 4
# Chance that a pair at the threshold shares no band, and that one is dropped while its signatures are compared.
MISS = 1e-6
# Signature values compared at a time.
BATCH = 16
SEED = 11
# Nodes, and bytes of their shingle sets, of one side of a block that a task compares.
BLOCK_NODES = 2000
BLOCK_BYTES = 8 << 20
SIGNED = "row long, doc_id long, n_shingles long, key binary, signature binary"


def bands_for(threshold: tuple[int, int], band_rows: int = BAND_ROWS, miss: float = MISS) -> int:
    """So many bands that a pair at the threshold shares none with chance ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - (threshold[0] / threshold[1]) ** band_rows))


def least_matches(threshold: tuple[int, int], size: int, miss: float = MISS, batch: int = BATCH) -> list[tuple[int, int]]:
    """(n, m) for each step: a pair with fewer than m matches in its first n values is dropped.

    With a uniform prior, the similarity of a pair with m of n matches is
    Beta(m + 1, n - m + 1); it is dropped when it is above the threshold with
    probability less than ``miss``, and when, besides, a pair at the threshold
    comes to so few matches in one of the steps with chance ``miss`` at most.
    """
    edge = threshold[0] / threshold[1]
    grid = (np.arange(200_000) + 0.5) / 200_000
    above = grid >= edge
    sizes = [*range(batch, size, batch), size]
    out = []
    for n in sizes:
        least, tail = 0, 0.0
        while least < n:
            log = least * np.log(grid) + (n - least) * np.log1p(-grid)
            density = np.exp(log - log.max())
            tail += math.comb(n, least) * edge**least * (1 - edge) ** (n - least)
            if density[above].sum() >= miss * density.sum() or tail > miss / len(sizes):
                break
            least += 1
        out.append((n, least))
    return out


def _functions(size: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed)
    return draw.integers(0, 1 << 31, size, np.uint32) * np.uint32(2) + np.uint32(1), draw.integers(0, 1 << 32, size, np.uint32)


def signature(found: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of each function over the shingles, a few thousand at a time."""
    slopes, shifts = functions
    out = np.full(len(slopes), 0xFFFFFFFF, np.uint32)
    high = (found >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(high), 2048):
        values = slopes[:, None] * high[None, start : start + 2048]
        values += shifts[:, None]
        np.minimum(out, values.min(axis=1), out=out)
    return out


def _sign(docs: DataFrame, words: int, size: int) -> DataFrame:
    """``SIGNED``, one row per row of ``docs``; ``key`` is a digest of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = _functions(size)
        for batch in batches:
            counts, keys, signatures = [], [], []
            for hashed in hashes_of_texts(batch["text"].to_pylist()):
                found = shingles_of(hashed, words)
                counts.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signatures.append(signature(found, functions).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())],
                names=["row", "doc_id", "n_shingles", "key", "signature"],
            )

    slim = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return slim.mapInArrow(frugal(run), SIGNED)


def _alike(pairs: DataFrame, nodes: DataFrame, steps: list[tuple[int, int]]) -> DataFrame:
    """The pairs (a, b) that no batch of signature values rules out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in ("left", "right"))
            alive, matches, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
            for n, least in steps:
                matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                alive, done = alive[matches[alive] >= least], n
            yield pa.RecordBatch.from_arrays([batch["a"].take(pa.array(alive)), batch["b"].take(pa.array(alive))], names=["a", "b"])

    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("left"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("right"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(frugal(run), "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs whose whole shingle sets are similar enough."""
    part, whole = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, (x, y) in enumerate(zip(batch["left"], batch["right"])):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if whole * min(len(x), len(y)) < part * max(len(x), len(y)):
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                if whole * both >= part * (len(x) + len(y) - both):
                    keep.append(n)
            chosen = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["a"].take(chosen), batch["b"].take(chosen)], names=["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("found").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("found").alias("right"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(frugal(run), "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, found): the whole sets of the wanted nodes, read again from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for hashed in hashes_of_texts(batch["text"].to_pylist()):
                one = shingles_of(hashed, words)
                keys.append(xxhash.xxh3_128_digest(one.tobytes()))
                found.append(one.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.binary())], names=["key", "found"])

    ids = wanted.select(F.col("doc_id").alias("_id")).distinct().hint("shuffle_hash")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = slim.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")
    return texts.mapInArrow(frugal(run), "key binary, found binary").join(wanted.select("key", "node"), "key").dropDuplicates(["node"]).select("node", "found")


def near_duplicates(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    threshold: tuple[int, int] = THRESHOLD,
    band_rows: int = BAND_ROWS,
    miss: float = MISS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, row.

    Links are pairs of shingle sets with intersection / union at or above
    ``threshold`` (numerator, denominator). Equal sets are one node from the
    start. Nodes that share a band of signature values are candidates; a
    candidate is dropped as soon as a batch of values makes a similarity above
    the threshold less likely than ``miss``, and what is left is confirmed on
    whole sets.

    Candidates within a bucket are not spelled out as all pairs. First each
    bucket's members are paired with its least one; what these stars link is one
    component. Then, in blocks, members of different
    components are compared, and only links that join components come out. So
    every candidate is compared or already connected.

    A document without words is linked with nothing. A null text is empty; a
    component's id is its smallest doc_id that is not null, and rows with a null
    doc_id are kept only where the whole component has none. Rows that repeat a
    doc_id count each on their own. No rows give no rows. Other columns are
    ignored.
    """
    size = band_rows * bands_for(threshold, band_rows, miss)
    steps = least_matches(threshold, size, miss)
    signed = written(_sign(docs, words, size), "signatures")
    nodes = written(
        signed.where("key is not null").groupBy("key")
        .agg(F.min(F.struct("row", "doc_id")).alias("at"), F.min("doc_id").alias("first_id"), F.first("signature").alias("signature"))
        .select(F.col("at.row").alias("node"), F.col("at.doc_id").alias("doc_id"), "first_id", "key", "signature"),
        "signature-classes",
    )
    width = band_rows * 4
    slices = [F.xxhash64(F.lit(i), F.substring("signature", i * width + 1, width)) for i in range(size // band_rows)]
    banded = nodes.select("node", F.posexplode(F.array(*slices)).alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1").drop("n")
    members = written(banded.join(shared, "bucket"), "buckets")
    wanted = members.select("node").distinct().join(nodes, "node").select("node", "key", "doc_id")
    sets = written(_sets(docs, wanted, words), "shingle-sets")

    star = members.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    alike = written(_alike(star, nodes, steps), "alike")
    links = written(_confirmed(alike, sets, threshold), "links")
    labels = written(components(links).select("node", F.col("component").alias("label")), "labels")
    more = written(_between_components(members, labels, nodes, sets, steps, threshold, band_rows), "links")
    if not more.isEmpty():
        labels = written(components(links.unionByName(more)).select("node", F.col("component").alias("label")), "labels")

    classes = nodes.join(labels, "node", "left").select("key", "first_id", F.coalesce("label", "node").alias("label"))
    least = classes.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_key = written(classes.join(least, "label").select("key", "component_id"), "set-components")
    whole = signed.where("key is not null").join(of_key, "key").select("doc_id", "n_shingles", "component_id", "row")
    alone = signed.where("key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "row")
    return whole.unionByName(alone).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "row")


def _split_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    known = members.join(labels, "node", "left").select("bucket", F.coalesce("label", "node").alias("label"))
    mixed = known.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("bucket")
    return members.join(mixed, "bucket", "left_semi")


def _between_components(members: DataFrame, labels: DataFrame, nodes: DataFrame, sets: DataFrame, steps, threshold, band_rows: int) -> DataFrame:
    """Links (a, b) that join the components a bucket is split into, as few as do.

    The members outside a bucket's largest component are held against all its
    members, in blocks: both sides are cut by hash into chunks of bounded
    count and bytes, and a task compares one chunk of each. Signatures are
    compared in batches, a pair only in the first band it shares; survivors
    are counted exactly, one member against a chunk at a time, through the
    lists of who holds each shingle.
    """
    part, whole = threshold
    sized = nodes.join(sets, "node").select("node", "signature", "found")
    split = written(
        _split_buckets(members, labels).select("band", "bucket", "node").join(labels, "node", "left")
        .select("band", "bucket", "node", F.coalesce("label", "node").alias("label"))
        .join(sets.select("node", F.octet_length("found").alias("bytes")), "node"),
        "open-buckets",
    )
    main = split.groupBy("bucket", "label").count().groupBy("bucket").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    placed = split.join(main, "bucket").withColumn("odd", F.col("label") != F.col("main"))
    chunks = [F.greatest(F.ceil(F.sum(F.when(own, 1)) / BLOCK_NODES), F.ceil(F.sum(F.when(own, F.col("bytes"))) / BLOCK_BYTES)).cast("int")
              for own in (F.lit(True), F.col("odd"))]
    counts = placed.groupBy("bucket").agg(chunks[0].alias("all_chunks"), chunks[1].alias("odd_chunks"))
    placed = written(placed.join(counts, "bucket"), "open-members")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    common = ["band", "bucket", "node", "label"]
    sides = (
        placed.select(*common, F.lit(0).alias("side"), own("all_chunks").alias("j"), spread("odd_chunks").alias("i"))
        .unionByName(placed.where("odd").select(*common, F.lit(1).alias("side"), own("odd_chunks").alias("i"), spread("all_chunks").alias("j")))
    )

    def compare(rows: pa.Table) -> pa.Table:
        side, node, label = (rows[c].to_numpy() for c in ("side", "node", "label"))
        signed = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint32).reshape(len(node), -1)
        found = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["found"]]
        band, sizes = rows["band"][0].as_py(), np.array([len(f) for f in found])
        odd, every = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        united = label.copy()
        held = np.concatenate([found[i] for i in every]) if len(every) else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(every)), sizes[every])
        order = np.argsort(held, kind="stable")
        held, owner = held[order], owner[order]
        pairs = []
        for x in odd:
            # What links join already is not compared again.
            apart = np.flatnonzero(united[every] != united[x])
            if not len(apart):
                continue
            others = every[apart]
            same = signed[others] == signed[x]
            shared = same.reshape(len(others), -1, band_rows).all(axis=2)
            alive = (shared.argmax(axis=1) == band) & shared[:, band]
            matches, done = np.zeros(len(others), np.int64), 0
            for n, least in steps:
                matches += same[:, done:n].sum(axis=1)
                alive &= matches >= least
                done = n
            if not alive.any():
                continue
            low, high = np.searchsorted(held, found[x], "left"), np.searchsorted(held, found[x], "right")
            many = high - low
            at = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            both = np.bincount(owner[at], minlength=len(every))[apart]
            linked = alive & (whole * both >= part * (sizes[others] + sizes[x] - both))
            for y in others[linked]:
                if united[x] != united[y]:
                    united[united == united[x]] = united[y]
                    pairs.append((int(node[x]), int(node[y])))
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    return sides.join(sized, "node").groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long")


def distinct_documents(docs: DataFrame, words: int = SHINGLE_WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns.

    A component keeps the rows of its smallest doc_id. Documents are expected to
    have ids of their own: rows that repeat an id are kept or dropped together,
    kept if any of them is.
    """
    (kept_id,) = free(docs, "_kept_id")
    kept = near_duplicates(docs, words, threshold).where("kept").select(F.col("doc_id").alias(kept_id)).distinct().hint("shuffle_hash")
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)), "left_semi")
