"""Embedding near-duplicates by a subspace pigeonhole join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.common import components, written

COSINE = 0.98
# Dimensions of a block of the rotated vector. Finer blocks have fewer cells to probe but let more pairs through.
BLOCK = 8
# Borders between cells along each dimension of a block, in units of the mean spread
# of a coordinate of a unit vector. More borders suit more vectors to a label.
CUTS = (0.0,)
SEED = 5
# Rounding of the rotated coordinates, which are kept in single precision.
SLACK = 1e-5
PLACED = "role int, block int, cell long, node long, coords array<float>"


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for a size and seed everywhere."""
    matrix, upper = np.linalg.qr(np.random.default_rng(seed + size).standard_normal((size, size)))
    return matrix * np.sign(np.diag(upper))


def _touched(coords: np.ndarray, radius: float, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own cells, rows, cells): each row's own cell, and all cells its ball reaches.

    Cells are products of intervals. Going through the dimensions, a partial
    cell is kept while the squared distance to it stays within the radius.
    """
    count, width = coords.shape
    base = len(borders) + 1
    own = np.zeros(count, np.int64)
    rows, cells, used = np.arange(count), np.zeros(count, np.int64), np.zeros(count)
    edges = np.concatenate([[-np.inf], borders, [np.inf]])
    for d in range(width):
        x = coords[:, d]
        own = own * base + np.searchsorted(borders, x, side="right")
        next_rows, next_cells, next_used = [], [], []
        for interval in range(base):
            low, high = edges[interval], edges[interval + 1]
            gap = np.maximum(np.maximum(low - x[rows], x[rows] - high), 0.0)
            total = used + gap * gap
            near = total <= radius * radius
            next_rows.append(rows[near])
            next_cells.append(cells[near] * base + interval)
            next_used.append(total[near])
        rows, cells, used = (np.concatenate(v) for v in (next_rows, next_cells, next_used))
    return own, rows, cells


def _place(vectors: DataFrame, cosine: float, block: int, cuts: tuple[float, ...], seed: int) -> DataFrame:
    """``PLACED``: for each block a row for a vector's own cell (role 0) and one for each cell within reach (role 1)."""
    budget = 2.0 - 2.0 * cosine

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                nodes = part["node"].to_numpy()
                vectors = [np.asarray(v, np.float64) for v in part["embedding"].to_pylist()]
                sizes = np.array([len(v) for v in vectors])
                for size in np.unique(sizes):
                    which = np.flatnonzero(sizes == size)
                    whole = np.stack([vectors[i] for i in which])
                    whole /= np.abs(whole).max(axis=1)[:, None]  # against overflow of the squares
                    whole /= np.linalg.norm(whole, axis=1)[:, None]
                    if size not in turns:
                        turns[size] = rotation(int(size), seed)
                    turned = (whole @ turns[size]).astype(np.float32).astype(np.float64)
                    for n, low in enumerate(range(0, size, block)):
                        coords = turned[:, low : low + block]
                        radius = np.sqrt(budget * coords.shape[1] / size) + SLACK
                        own, rows, cells = _touched(coords, radius, np.array(cuts) / np.sqrt(size))
                        for role, r, c in ((0, np.arange(len(which)), own), (1, rows, cells)):
                            flat = pa.array(coords[r].astype(np.float32).ravel())
                            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(r) + 1, dtype=np.int32) * coords.shape[1]), flat)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(r), role, np.int32)), pa.array(np.full(len(r), n, np.int32)), pa.array(c),
                                 pa.array(nodes[which[r]]), lists],
                                names=["role", "block", "cell", "node", "coords"],
                            )

    return vectors.select("node", "embedding").mapInArrow(run, PLACED)


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    block: int = BLOCK,
    cuts: tuple[float, ...] = CUTS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept, row.

    Two vectors are linked when they have the same label, the same number of
    dimensions, and a cosine of at least ``cosine`` in double precision. The
    squared distance of their unit vectors is then 2 - 2 cosine at most, so
    after any rotation one block of the coordinates has no more than its share
    of it. Each block is joined on that distance over a grid: every vector
    probes the cells within reach. The union of what the blocks find is
    confirmed on the stored vectors.

    Equal vectors of a label are one node with a count; their links to each
    other are counted, not listed. A vector that is null, empty, all zero, or
    holds a null, NaN or infinite value, and one with a null label, is linked
    with nothing. Null ids are never a component's id. Repeated ids count each
    on their own. No rows give no rows. Other columns are ignored.
    """
    bad = "exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    held = written(
        vectors.select(
            F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"),
        ).withColumn("usable", F.expr(f"label is not null and coalesce(size(embedding) > 0 and not {bad} and exists(embedding, x -> x <> 0), false)")),
        "vectors",
    )
    nodes = written(
        held.where("usable").groupBy("label", "embedding").agg(F.min("row").alias("node"), F.count("*").alias("copies"), F.min("vec_id").alias("first_id")),
        "vector-classes",
    )
    placed = written(
        _place(nodes, cosine, block, cuts, seed).join(nodes.select("node", "label", F.size("embedding").alias("dims")), "node"), "vector-cells"
    )
    coords = [F.coalesce(F.get("coords", F.lit(i)), F.lit(0.0)).cast("double") for i in range(block)]
    key = ["label", "dims", "block", "cell"]
    own = placed.where("role = 0").select(*key, F.col("node").alias("b"), *[c.alias(f"y{i}") for i, c in enumerate(coords)])
    probe = placed.where("role = 1").select(*key, F.col("node").alias("a"), *[c.alias(f"x{i}") for i, c in enumerate(coords)])
    apart = " + ".join(f"(x{i} - y{i}) * (x{i} - y{i})" for i in range(block))
    reach = F.expr(f"pow(sqrt({2.0 - 2.0 * cosine!r}D * least({block}, dims - block * {block}) / dims) + {SLACK!r}D, 2)")
    found = probe.join(own, key).where((F.col("a") < F.col("b")) & (F.expr(apart) <= reach)).select("a", "b").distinct()

    dot = "aggregate(zip_with(x, y, (p, q) -> p * q), 0D, (s, v) -> s + v)"
    unit = nodes.select("node", F.expr("transform(embedding, v -> v / array_max(transform(embedding, w -> abs(w))))").alias("v"))
    unit = unit.select("node", F.expr("transform(v, p -> p / sqrt(aggregate(v, 0D, (s, w) -> s + w * w)))").alias("v"))
    links = written(
        found.join(unit.select(F.col("node").alias("a"), F.col("v").alias("x")), "a")
        .join(unit.select(F.col("node").alias("b"), F.col("v").alias("y")), "b")
        .where(f"{dot} >= {cosine!r}D").select("a", "b"),
        "vector-links",
    )
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("linked"))
    joined = components(links, "vector-components").withColumnRenamed("component", "label_node")
    labels = nodes.join(joined, "node", "left").select("node", "first_id", "copies", F.coalesce("label_node", "node").alias("group"))
    least = labels.groupBy("group").agg(F.min("first_id").alias("component_id"))
    of_node = written(
        labels.join(least, "group").join(counts, F.col("node") == F.col("a"), "left")
        .select("node", "component_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")),
        "vector-result",
    )
    member = held.where("usable").join(nodes.select("label", "embedding", "node"), ["label", "embedding"]).join(of_node, "node")
    member = member.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", "row")
    alone = held.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), "row")
    return member.unionByName(alone).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"), "row"
    )
