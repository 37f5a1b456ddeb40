"""Written scratch tables, global row numbers, running totals, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakelayers.session import scratch_dir

# Rows of one block of a running total: a block fits one task, and so do the blocks' sums.
TOTAL_BLOCK = 4096

# A component label reaches every node of a path of n nodes in about log2(n) rounds.
MAX_ROUNDS = 64


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: lineage ends here.

    What follows reads finished files, so a lost executor costs a re-read and
    not a re-run, and row ids given before the write stay as they are.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def running_total(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Adds ``out``, the sum of ``value`` over all rows with a smaller ``order``.

    ``order`` holds distinct integers from 0. Two levels: sums of blocks of
    TOTAL_BLOCK rows are totalled first, so a window holds one block, and the
    window over blocks one row per block.
    """
    block = F.floor(F.col(order) / TOTAL_BLOCK).alias("_block")
    blocks = df.groupBy(block).agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_block", F.floor(F.col(order) / TOTAL_BLOCK))
        .withColumn("_before", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, "_block")
        .withColumn(out, (F.col("_start") + F.col("_before")).cast("long"))
        .drop("_block", "_start", "_before")
    )


def row_numbers(df: DataFrame, order: list, label: str, out: str = "row_number") -> DataFrame:
    """Adds the global row number from 0 in the order of ``order``, which must be total.

    One range shuffle; tasks number their own rows, and only one count per task
    is summed up. The numbered rows are written, because the borders of a range
    shuffle come from a sample and must not be drawn twice.
    """
    placed = written(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()),
        label,
    )
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    starts = running_total(sizes, "_part", "_rows", "_first").select("_part", "_first")
    return (
        placed.withColumn("_part", part)
        .join(starts, "_part")
        .withColumn(out, F.col("_first") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_place", "_part", "_first")
    )


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the smallest node each node of ``links`` (a, b) can reach.

    Alternates two steps until nothing changes: every node's greater neighbours
    are tied to its smallest one, then its smaller neighbours are. Each round
    is a pair of aggregations and joins over the links, written and summed up;
    paths halve, so rounds grow with the logarithm of the longest path. A node
    with very many links is no hot spot: its minimum is pre-aggregated, and
    the join that hands it out is one that Spark may split.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label
    )
    was = None
    for _ in range(MAX_ROUNDS):
        # Distinct edges that are as many, with the same sum and parity of hashes, are the same edges.
        code = F.xxhash64("u", "v")
        now = tuple(edges.agg(F.count("*"), F.sum(code.cast("decimal(20,0)")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if now == was or not now[0]:
            return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        was, edges = now, written(_small_star(written(_large_star(edges), label)), label)
    raise RuntimeError("components did not settle")


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties each node's greater neighbours to the smallest of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties each node and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(smallest.withColumnRenamed("m", "v")).distinct()


def free(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
