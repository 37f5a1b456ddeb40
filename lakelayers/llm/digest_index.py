"""Exact de-duplication against a persistent index of text digests."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.llm.common import free, written
from lakelayers.session import scratch_dir

# Batches that a whole table is added in.
BATCHES = 3
_BLANK = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), _BLANK, "")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


@dataclass
class DigestIndex:
    """(text_sha256, keep_id, n_points, batch) of all texts seen, bucketed and sorted by digest.

    A catalogue table over a folder of Parquet files, declared anew over the
    same folder by each ``open`` and taken from the catalogue by ``close``; the
    files stay. ``buckets`` is fixed for the life of the index, by default the
    session's shuffle width when it is made: choose it so that a bucket of the
    final index fits a task. Only what is new is ever written, so adding costs
    the batch and a read of the index, without a shuffle of it.
    """

    spark: SparkSession
    path: str
    table: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int | None = None) -> DigestIndex:
        table = f"digest_index_{uuid.uuid4().hex[:12]}"
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.sql(
            f"CREATE TABLE {table} (text_sha256 STRING, keep_id BIGINT, n_points BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return cls(spark, path, table, buckets)

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def __enter__(self) -> DigestIndex:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """De-duplicates ``docs`` against the index and itself, and appends what is new.

        One row per row of ``docs``: doc_id, keep_id, group_size, kept,
        text_sha256, n_points. A text that the index holds stays with the row it
        was first kept for; else, of the batch's equal texts, the row with most
        code points, then smallest doc_id (null last). ``group_size`` counts the
        batch's rows. Of repeated rows of one doc_id one is kept. Null text is
        empty text; all empty texts are equal. Long texts are read whole. No
        rows give no rows. Other columns are ignored.

        ``batch`` names the batch. One that is added again, because its first
        try failed anywhere, has the same outcome as if that had not been, and
        appends only what is missing; so a caller that lost the answer asks again.

        Groups are reduced before the shuffle, so thousands of copies travel as
        a row per task; the index side of the sort-merge anti-join is read in
        its buckets. The last join hands the decision to each row, and Spark may
        split its hot keys.
        """
        return self.add_digests(_digests(docs), batch)

    def add_digests(self, rows: DataFrame, batch: str | None = None) -> DataFrame:
        """``add`` for rows of doc_id, text_sha256, n_points and a number of their own, ``row``."""
        batch = batch or uuid.uuid4().hex
        rank = F.struct((-F.col("n_points")).alias("short"), F.col("doc_id").isNull().alias("last"), "doc_id", "row")
        groups = rows.groupBy("text_sha256").agg(F.min(rank).alias("best"), F.count("*").alias("group_size"))
        groups = written(
            groups.select("text_sha256", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("row"),
                          F.coalesce(-F.col("best.short"), F.lit(0)).alias("n_points")),
            "digest-groups",
        )
        known = self.read().where(F.col("batch") != batch).hint("merge")
        fresh = written(groups.join(known, "text_sha256", "left_anti"), "digest-fresh")
        held = (
            groups.join(known.select("text_sha256", F.col("keep_id").alias("held_id")), "text_sha256")
            .select("text_sha256", "group_size", F.col("held_id").alias("keep_id"), F.lit(None).cast("long").alias("keep_row"))
        )
        decided = written(
            fresh.select("text_sha256", "group_size", "keep_id", F.col("row").alias("keep_row")).unionByName(held), "digest-kept"
        )
        # The answer is written: only now does the batch count as seen.
        before = self.read().where(F.col("batch") == batch).hint("merge")
        (
            fresh.join(before, "text_sha256", "left_anti").select("text_sha256", "keep_id", "n_points", F.lit(batch).alias("batch"))
            .repartition(self.buckets, "text_sha256").sortWithinPartitions("text_sha256")
            .write.insertInto(self.table)
        )
        return rows.join(decided, "text_sha256").select(
            "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
            F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
            "text_sha256", "n_points",
        )


def _digests(docs: DataFrame) -> DataFrame:
    return written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            digest(F.col("text")).alias("text_sha256"),
            F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_points"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )


def deduplicate(docs: DataFrame, buckets: int | None = None, batches: int = BATCHES) -> DataFrame:
    """``docs`` added to an index of its own in ``batches`` batches, longest texts first.

    One row per row of ``docs``, as from ``DigestIndex.add``, but ``group_size``
    counts the rows of all batches. As rows of one length are in one batch and
    longer ones in an earlier one, the row that the index holds of a text is
    the one with most code points, then smallest doc_id, of the whole table;
    shorter spellings of it, with less white space, meet it there. Null, empty
    and long texts, ties, repeated rows and no rows are as in ``add``.
    """
    spark, rows = docs.sparkSession, _digests(docs)
    shares = [n / batches for n in range(1, batches)]
    borders = rows.agg(F.percentile_approx("n_points", shares, 1000)).first()[0] if shares else None
    ends = [*sorted(set(borders or ()), reverse=True), -1]
    found, above = [], None
    with DigestIndex.open(spark, scratch_dir(spark, "digest-index"), buckets) as index:
        for n, low in enumerate(ends):
            within = F.col("n_points") > low
            found.append(index.add_digests(rows.where(within if above is None else within & (F.col("n_points") <= above)), f"batch-{n}"))
            above = low
    every = reduce(DataFrame.unionByName, found)
    if len(found) == 1:
        return every
    sizes = every.groupBy(F.col("text_sha256").alias("_of")).agg(F.count("*").alias("_size"))
    return every.join(sizes, F.col("text_sha256") == F.col("_of")).select(
        "doc_id", "keep_id", F.col("_size").cast("long").alias("group_size"), "kept", "text_sha256", "n_points"
    )


def distinct_documents(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """The rows of ``docs`` that ``deduplicate`` keeps, with all their columns.

    A document and its decision meet by digest and doc_id. Rows that repeat a
    doc_id and a text are told apart by nothing else, so where a kept one is
    repeated, one of its rows is taken.
    """
    sha, points, digest_, id_, points_ = free(docs, "_sha", "_points", "_digest", "_id", "_kept_points")
    keys = written(
        deduplicate(docs, buckets).where("doc_id <=> keep_id")
        .groupBy(F.col("text_sha256").alias(digest_), F.col("doc_id").alias(id_), F.col("n_points").alias(points_))
        .agg(F.sum(F.col("kept").cast("int")).alias("_kept"), F.count("*").alias("_twins")).where("_kept > 0"),
        "digest-keys",
    )
    length = F.coalesce(F.char_length("text"), F.lit(0)).cast("long")
    marked = docs.withColumns({sha: digest(F.col("text")), points: length})
    same = (F.col(sha) == F.col(digest_)) & F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(points) == F.col(points_))

    def taken(keys: DataFrame) -> DataFrame:
        return marked.join(keys, same, "left_semi")

    single = taken(keys.where("_twins = 1")).select(*docs.columns)
    repeated = keys.where("_twins > 1")
    if repeated.isEmpty():
        return single
    one = taken(repeated).dropDuplicates([sha, "doc_id", points]).select(*docs.columns)
    return single.unionByName(one)
