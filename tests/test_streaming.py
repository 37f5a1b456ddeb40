import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakelayers import Context
from lakelayers.operators.publish import Layout
from lakelayers.plans import bronze
from lakelayers.sources.benchmark import BenchmarkSources, change_batch
from lakelayers.sources.registry import ParquetSources
from lakelayers.streaming import ingest

EVENTS = "event_id bigint, ts timestamp_ntz, v string"
ORDERS = "id bigint, at bigint, v string"


def events(spark, data):
    df = spark.createDataFrame(data, "event_id bigint, minute int, v string")
    return df.selectExpr("event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, minute) AS ts", "v")


@pytest.mark.parametrize("spread", [True, False])
def test_repeats_are_dropped_across_batches(spark, tmp_path, spread):
    drop, out, checkpoint = (str(tmp_path / p) for p in ("drop", "out", "checkpoint"))

    def deliver(data):
        events(spark, data).repartition(3).write.mode("append").parquet(drop)
        stream = spark.readStream.schema(EVENTS).parquet(drop)
        with ingest.state_settings(spark):
            once = ingest.drop_repeats(stream, ["event_id"], "ts", spread=spread)
            ingest.append_files(once, out, checkpoint).awaitTermination()

    deliver([(1, 0, "a"), (2, 1, "b"), (2, 1, "b")] + [(9, 2, "hot")] * 50)
    deliver([(1, 0, "a"), (3, 5, "c")] + [(9, 2, "hot")] * 50)
    assert rows(spark.read.parquet(out), "event_id", "v") == [(1, "a"), (2, "b"), (3, "c"), (9, "hot")]


@pytest.mark.parametrize("spread", [True, False])
def test_first_arrivals_are_appended_and_counted(spark, tmp_path, spread):
    drop, out, checkpoint = (str(tmp_path / p) for p in ("drop", "out", "checkpoint"))

    def deliver(data):
        events(spark, data).write.mode("append").parquet(drop)
        stream = spark.readStream.schema(EVENTS).parquet(drop)
        return ingest.first_arrivals(stream, out, checkpoint, ["event_id"], "ts", "10 minutes", state_tasks=3, spread=spread)

    def stored():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "out").glob("*.parquet")}

    seen = deliver([(1, 0, "a"), (2, 95, "b"), (2, 95, "b"), (3, 100, "c")])
    assert (seen.arrived, seen.kept, seen.too_late, seen.repeats) == (4, 3, 0, 1)
    before = stored()
    # The mark is at 90: within the delay, long gone, new but too late, and new.
    seen = deliver([(2, 99, "copy"), (1, 100, "again"), (4, 89, "late"), (3, 90, "copy, late"), (5, 91, "new")])
    assert (seen.arrived, seen.kept, seen.too_late, seen.repeats) == (5, 2, 2, 1)
    assert rows(spark.read.parquet(out), "event_id", "v") == [(1, "a"), (1, "again"), (2, "b"), (3, "c"), (5, "new")]
    assert before.items() <= stored().items()


def test_a_run_keeps_no_more_than_the_delay(spark, tmp_path):
    """What a run writes and remembers follows what arrives and not what is stored."""
    drop, out, checkpoint = (str(tmp_path / p) for p in ("drop", "out", "checkpoint"))
    written = []
    for lot in range(4):
        events(spark, [(lot * 500 + n, lot * 500 + n, "x" * 50) for n in range(500)]).write.mode("append").parquet(drop)
        stream = spark.readStream.schema(EVENTS).parquet(drop)
        before = set((tmp_path / "out").glob("*.parquet"))
        with ingest.state_settings(spark, 2):
            query = ingest.append_files(ingest.drop_repeats(stream, ["event_id"], "ts", "1 hour"), out, checkpoint)
            query.awaitTermination()
        written.append(sum(p.stat().st_size for p in set((tmp_path / "out").glob("*.parquet")) - before))
        assert query.lastProgress.stateOperators[0].numRowsTotal <= 2 * 60 + 1
    assert max(written) < 1.5 * min(written)
    assert spark.read.parquet(out).count() == 2000


def test_state_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with ingest.state_settings(spark, 7):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_no_new_event_is_too_late(spark, store, tmp_path):
    drop = str(tmp_path / "drop")

    def deliver(data):
        events(spark, data).write.mode("append").parquet(drop)
        stream = spark.readStream.schema(EVENTS).parquet(drop)
        ingest.take_in(stream, store, "bronze.events", ["event_id"], "ts", str(tmp_path / "checkpoint")).awaitTermination()

    deliver([(1, 500, "a"), (2, 501, "b"), (2, 501, "b")])
    deliver([(3, 0, "seven hours older"), (1, 500, "a"), (4, 502, "d")])
    deliver([(3, 0, "seven hours older")])
    assert rows(store.read("bronze.events"), "event_id", "v") == [(1, "a"), (2, "b"), (3, "seven hours older"), (4, "d")]


@pytest.fixture
def upserts(spark, store, tmp_path):
    drop, checkpoint = str(tmp_path / "drop"), str(tmp_path / "checkpoint")

    def deliver(data, checkpoint=checkpoint, files=None):
        if data:
            spark.createDataFrame(data, ORDERS).coalesce(1).write.mode("append").parquet(drop)
        reader = spark.readStream.schema(ORDERS)
        if files:
            reader = reader.option("maxFilesPerTrigger", files)
        ingest.upsert(
            reader.parquet(drop), store, "bronze.t", lambda df: df.withColumn("v", F.upper("v")),
            ["id"], "at", checkpoint, Layout(),
        ).awaitTermination()
        return rows(store.read("bronze.t"))

    return deliver


def test_upsert(upserts):
    assert upserts([(1, 1, "a"), (2, 1, "b"), (2, 3, "newest"), (2, 2, "newer")]) == [(1, 1, "A"), (2, 3, "NEWEST")]
    assert upserts([(1, 2, "a2"), (2, 2, "late"), (3, 1, "c")]) == [(1, 2, "A2"), (2, 3, "NEWEST"), (3, 1, "C")]


def test_a_new_stream_over_the_same_files_changes_nothing(upserts, store, tmp_path):
    upserts([(1, 1, "a")])
    once = upserts([(1, 2, "b"), (2, 1, "c")])
    assert upserts([], checkpoint=str(tmp_path / "second"), files=1) == once
    assert len(store.version("bronze.t").tags) == 2


def test_replayed_batch_is_skipped(upserts, store, spark, tmp_path):
    import shutil

    upserts([(1, 1, "a")])
    # Lose the record that batch 0 was finished, as when a driver dies right after the merge.
    shutil.copytree(tmp_path / "checkpoint", tmp_path / "restarted", ignore=shutil.ignore_patterns("commits"))
    before = store.versions("bronze.t")
    assert upserts([], checkpoint=str(tmp_path / "restarted")) == [(1, 1, "A")]
    assert store.versions("bronze.t") == before


def test_store_streams_fill_bronze(spark, store, tmp_path):
    raw = {t: BenchmarkSources(spark, "/root/testdata/sf0.001").scan("br_src_shopify_uk", t) for t in ("orders", "customers")}
    root, source = str(tmp_path / "raw"), "br_src_shopify_uk"
    sources = ParquetSources(spark, root, {(source, t): df.schema for t, df in raw.items()})
    ctx = Context(spark, sources, store)

    def arrive(table, df):
        df.write.mode("append").parquet(sources.path(source, table))
        ingest.upsert_store(ctx, "yoga-uk", table, str(tmp_path / "checkpoints")).awaitTermination()

    arrive("customers", raw["customers"])
    arrive("orders", raw["orders"])
    arrive("orders", change_batch(raw["orders"]))
    assert ctx.ref("bronze.br_src_shopify_uk_customers").count() == raw["customers"].count()
    kept = raw["orders"].filter("id % 10 != 0").unionByName(change_batch(raw["orders"]))
    want, got = bronze.orders(kept, "yoga-uk"), ctx.ref("bronze.br_src_shopify_uk_orders")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
