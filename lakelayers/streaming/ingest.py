"""Streams of raw events: dropping repeats, and upserts into bronze."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakelayers import settings
from lakelayers.context import Context
from lakelayers.operators.conform import latest_per_key
from lakelayers.operators.merge import merge
from lakelayers.operators.publish import Layout, TableStore
from lakelayers.plans import bronze

# Keeps state on executor disks, so it may outgrow the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_settings(spark: SparkSession, state_tasks: int | None = None) -> Iterator[None]:
    """Settings for starting a stream that keeps state; put back afterwards.

    A stream keeps the shuffle width it is first started with, one state store
    per task, for as long as its checkpoint lives. ``state_tasks`` is that
    width: choose it for the cluster and state the stream will grow to. By
    default it is the session's shuffle width.
    """
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if state_tasks is not None:
        wanted["spark.sql.shuffle.partitions"] = str(state_tasks)
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def drop_repeats(
    stream: DataFrame, keys: Sequence[str], event_time: str, delay: str = "1 hour", spread: bool = False
) -> DataFrame:
    """The first arrival of each key; its copies within ``delay`` are dropped.

    State of a key is let go once the watermark has passed it by ``delay``, and
    rows that come later than that are dropped by the engine, new keys too:
    for streams in which that is wanted. ``take_in`` loses none. Rows without a
    key count as copies of each other, as they do for Spark. ``spread``
    first drops copies per input split, for a stream much of which is copies of
    one key; it keeps state twice.
    """
    keys = list(keys)
    rows = stream.withColumn(event_time, stream[event_time].cast("timestamp")).withWatermark(event_time, delay)
    if spread:
        rows = rows.withColumn("_split", F.spark_partition_id())
        rows = rows.dropDuplicatesWithinWatermark([*keys, "_split"]).drop("_split")
    return rows.dropDuplicatesWithinWatermark(keys)


@dataclass(frozen=True)
class Arrivals:
    """What a run of a stream saw: rows that arrived, rows kept, and rows dropped as too late."""

    arrived: int
    kept: int
    too_late: int

    @property
    def repeats(self) -> int:
        return self.arrived - self.kept - self.too_late


def first_arrivals(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    event_time: str,
    delay: str = "1 hour",
    state_tasks: int | None = None,
    spread: bool = False,
) -> Arrivals:
    """Append the first arrival of each key to Parquet files at ``path``; takes in all that is there.

    The memory is the state of ``drop_repeats``, on executor disks, and holds the
    keys of about the last ``delay`` only. So nothing stored is read or written
    again, however much there is, and a run costs what arrives. Of a key whose
    copies lie further apart than ``delay`` a later one is a new row, and a row
    that is more than ``delay`` older than the newest of earlier batches is
    dropped and counted. Where no new row may be lost, use ``take_in``.

    A batch that is run again after a failure writes the same files once: the
    sink's log names the files of finished batches.
    """
    counted = stream.observe("arrived", F.count(F.lit(1)).alias("rows"))
    with state_settings(stream.sparkSession, state_tasks):
        kept = drop_repeats(counted, keys, event_time, delay, spread).observe("kept", F.count(F.lit(1)).alias("rows"))
        query = append_files(kept, path, checkpoint)
        query.awaitTermination()
    return arrivals(query)


def arrivals(query: StreamingQuery) -> Arrivals:
    """The counts of a finished query, summed over its last batches that Spark keeps (100 by default)."""

    def observed(name: str) -> int:
        return sum(p.observedMetrics[name].rows for p in query.recentProgress if name in p.observedMetrics)

    late = sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)
    return Arrivals(observed("arrived"), observed("kept"), late)


def take_in(
    stream: DataFrame,
    tables: TableStore,
    name: str,
    keys: Sequence[str],
    event_time: str,
    checkpoint: str,
    layout: Layout | None = None,
) -> StreamingQuery:
    """Add the events of each batch whose key the table ``name`` does not hold yet.

    However late a new event is, it gets in; a copy of one that is stored does
    not. The table itself is the memory, so nothing is forgotten. Give a layout
    with buckets by key: a batch reads the buckets of its keys, and rewrites
    those that get new rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tag = (_stream_id(tables.spark, checkpoint), batch_id)
        merge(tables, name, latest_per_key(batch, keys, [event_time]), keys, layout, tag=tag, insert_only=True)

    return _started(stream, write, checkpoint)


def append_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all that has arrived to Parquet files, each row once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave this stream; a new checkpoint starts a new one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def upsert(
    stream: DataFrame,
    tables: TableStore,
    name: str,
    model: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    newer_by: str,
    checkpoint: str,
    layout: Layout | None = None,
) -> StreamingQuery:
    """Merge every batch of a stream into ``name``.

    A batch may be delivered again after a failure: one recorded with the
    table is skipped, and a change older than the stored row is left out. With
    buckets by key in the layout, a batch reads and rewrites those of its keys.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(model(batch), keys, [newer_by])
        stream_id = _stream_id(tables.spark, checkpoint)
        merge(tables, name, rows, keys, layout, newer_by=newer_by, tag=(stream_id, batch_id))

    return _started(stream, write, checkpoint)


def _started(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_store(ctx: Context, store: str, table: str, checkpoints: str, max_files: int | None = None) -> StreamingQuery:
    """Take one store's streamed ``orders`` or ``customers`` into a bronze table of its own.

    One writer per table: the daily run merges batch orders into another, and
    silver and gold take the newer row of each order from the two.
    """
    source = settings.STORE_STREAM_SOURCES[store]
    name = f"bronze.{source}_{table}"
    if table == "orders":
        model, key, layout = (lambda raw: bronze.orders(raw, store)), "order_id", bronze.STREAM_LAYOUT
    else:
        model, key, layout = (lambda raw: raw), "customer_id", bronze.CUSTOMER_STREAM_LAYOUT
    return upsert(
        ctx.sources.stream(source, table, max_files), ctx.tables, name, model, [key], "updated_at",
        f"{checkpoints}/{source}/{table}", ctx.layout(name, layout),
    )
