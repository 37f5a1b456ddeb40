from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakelayers import Context, settings
from lakelayers.operators import monitors
from lakelayers.operators.publish import Layout, TableStore
from lakelayers.operators.quality import Check, QualityError
from lakelayers.plans import bronze, gold, runs, silver
from lakelayers.plans.models import Model, run_model
from lakelayers.sources.benchmark import BenchmarkSources, after_changes, change_batch
from lakelayers.sources.registry import ParquetSources
from lakelayers.streaming import ingest

SMALL = "/root/testdata/sf0.001"
RUN = datetime(2002, 1, 1)
# --- fixed values: the product seed ------------------------------------------
SEED = "product_id,product_name,category,price\n  1,Airlift Legging,Bottoms,128.00  \n  2,Define Jacket,Tops,168.00  \n  3,Warrior Mat,Accessories,96.00"


class UnevenSources(BenchmarkSources):
    """One store a thousand times bigger than the others."""

    def scan(self, source, table):
        df = super().scan(source, table)
        if table != "orders" or source == "src_shopify_us":
            return df
        return df.filter("id % 1000 = 1")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    ctx = Context(
        spark, BenchmarkSources(spark, SMALL), TableStore(spark, str(tmp_path_factory.mktemp("lake"))), run_at=RUN
    )
    seed = tmp_path_factory.mktemp("seeds") / "products.csv"
    seed.write_text(SEED)
    ctx.seeds = {"products": str(seed)}
    first = runs.run_daily(ctx)
    first_gold = rows(ctx.ref(runs.REVENUE_DAILY))
    untouched = runs.run_daily(ctx)
    ctx.sources.next_day = True
    ctx.run_at = RUN + timedelta(days=1)
    changed = runs.run_daily(ctx)
    return ctx, first, first_gold, untouched, changed


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_layers_run_in_order(lake):
    _, first, *_ = lake
    assert [s.layer for s in first.steps] == ["public", "snapshots", *["bronze"] * 5, "silver", "silver", "gold", "gold"]
    assert all(t.status == "pass" for t in first.tests) and len(first.tests) == len(runs.CHECKS)


def test_gold_of_the_first_run(spark, lake):
    _, _, first_gold, *_ = lake
    want = gold.revenue_daily(bronze.all_orders(Context(spark, BenchmarkSources(spark, SMALL))))
    assert first_gold == rows(want)


def test_a_run_without_changes_publishes_nothing(lake):
    _, first, _, untouched, _ = lake
    assert [(s.name, s.version) for s in first.steps] == [(s.name, s.version) for s in untouched.steps]


def test_the_seed_and_its_model_are_steps(lake):
    ctx, first, *_ = lake
    assert {"public.products", "bronze.products_with_tax"} <= {s.name for s in first.steps}
    assert rows(ctx.ref("bronze.products_with_tax"), "product_id", "price_with_tax") == [(1, 140.8), (2, 184.8), (3, 105.6)]


def test_stores_of_uneven_size_leave_gold_alone(spark, tmp_path):
    ctx = Context(spark, UnevenSources(spark, SMALL), TableStore(spark, str(tmp_path)), run_at=RUN)
    runs.run_daily(ctx, snapshots=False)
    again = runs.run_daily(ctx, snapshots=False)
    assert {s.name: s.version for s in again.steps}[runs.REVENUE_DAILY] == 1


def test_a_run_with_changes_equals_a_rebuild(spark, lake):
    ctx, _, _, _, changed = lake
    assert {s.name: s.version for s in changed.steps}[runs.REVENUE_DAILY] == 2
    merged = runs.bronze_orders(ctx)
    assert merged.filter("financial_status = 'refunded'").count() > 0
    assert same(ctx.ref(runs.REVENUE_DAILY), gold.revenue_daily(merged))
    monthly = gold.revenue_by_month(merged)
    assert same(ctx.ref(runs.REVENUE_MONTHLY), monthly)


def test_silver_view(spark, lake):
    ctx, *_ = lake
    ctx.tables.publish_views()  # other tests publish tables of these names in the same catalog
    orders = ctx.ref(runs.ORDERS_ENRICHED)
    assert orders.count() == runs.bronze_orders(ctx).count()
    assert orders.filter("customer_country IS NULL").count() == 0


def test_tables_have_views(spark, lake):
    ctx, *_ = lake
    ctx.tables.publish_views()
    assert spark.table("bronze.br_shopify_us_orders").count() == ctx.ref("bronze.br_shopify_us_orders").count()
    assert same(spark.table("gold.gold_revenue_daily"), ctx.ref(runs.REVENUE_DAILY))


def test_monitors(lake):
    ctx, *_ = lake
    for _ in range(2):  # the second run of one time changes nothing
        results = runs.run_monitors(ctx)
    assert set(results) == {m[0] for m in settings.MONITORS}
    volume = results["br_shopify_us_orders_volume"].collect()
    assert [r.metric_value for r in volume] == [float(ctx.ref("bronze.br_shopify_us_orders").count())]
    assert results["gold_revenue_daily_schema"].count() == 0
    ctx.run_at += timedelta(days=1)
    again = runs.run_monitors(ctx)["br_shopify_us_orders_revenue_anomaly"].collect()
    assert [(r.baseline_runs, r.is_anomaly) for r in again] == [(1, False)]


def test_freshness_by_footers_equals_a_scan(lake):
    ctx, *_ = lake
    for table, column in (("bronze.br_shopify_us_orders", "updated_at"), (runs.CUSTOMERS, "updated_at"), (runs.REVENUE_DAILY, "created_at_date")):
        by_scan = monitors.table_freshness(ctx.ref(table), table, column, 720, ctx.now)
        assert rows(runs._freshness(ctx, table, column, 720)) == rows(by_scan)
    assert ctx.tables.version(runs.CUSTOMERS).layout.mark == "updated_at"


def test_a_schema_change_is_seen_however_many_versions_ago(spark, store):
    ctx = Context(spark, None, store, run_at=RUN)
    store.replace("gold.seen", spark.range(2).toDF("id"))
    assert runs.run_schema_monitor(ctx, "gold.seen").count() == 0
    store.replace("gold.seen", spark.range(2).selectExpr("id", "'x' AS more"))
    store.replace("gold.seen", spark.range(3).selectExpr("id", "'x' AS more"))
    assert rows(runs.run_schema_monitor(ctx, "gold.seen"), "column_name", "change") == [("more", "added")]
    assert runs.run_schema_monitor(ctx, "gold.seen").count() == 0


def test_a_stream_and_the_daily_run_lose_nothing(spark, tmp_path):
    """The stream's newest row does not hide older batch rows, nor does a stale batch row undo it."""
    def order(id, hour, status):
        return (id, datetime(2024, 1, 5, hour), status)

    def frame(data):
        df = spark.createDataFrame(data, "id bigint, at timestamp, financial_status string")
        return df.selectExpr(
            "id", "timestamp'2024-01-01' AS created_at", "at AS updated_at", "at AS processed_at", "1L AS customer_id", "'e' AS email",
            "financial_status", "'f' AS fulfillment_status", "struct(struct('100' AS amount, 'USD' AS currency_code) AS shop_money) AS total_price_set",
            "'USD' AS currency", "at AS _fivetran_synced",
        )

    source, batch = "br_src_shopify_us", "src_shopify_us"
    schema = frame([]).schema
    raw = ParquetSources(spark, str(tmp_path / "raw"), {(source, "orders"): schema, (batch, "orders"): schema})
    ctx = Context(spark, raw, TableStore(spark, str(tmp_path / "lake")), run_at=RUN)
    for s in ("src_shopify_can", "src_shopify_uk", "src_shopify_intl", batch):
        rows_of = [order(1, 1, "old")] if s == batch else []
        frame(rows_of).write.parquet(raw.path(s, "orders"))
    model = runs.STORE_MODELS["yoga-us"]
    for m in runs.STORE_MODELS.values():
        run_model(ctx, m)
    frame([order(1, 10, "new"), order(2, 10, "new")]).write.parquet(raw.path(source, "orders"))
    ingest.upsert_store(ctx, "yoga-us", "orders", str(tmp_path / "checkpoints")).awaitTermination()
    frame([order(3, 5, "batch")]).write.mode("append").parquet(raw.path(batch, "orders"))
    run_model(ctx, replace(model, lookback=timedelta(days=1)))
    assert rows(runs.bronze_orders(ctx), "order_id", "financial_status") == [(1, "new"), (2, "new"), (3, "batch")]


def test_full_refresh_drops_what_the_source_lost(spark, tmp_path):
    sources = BenchmarkSources(spark, SMALL)
    ctx = Context(spark, sources, TableStore(spark, str(tmp_path)), run_at=RUN)
    sources.next_day = True
    runs.run_daily(ctx, snapshots=False)
    sources.next_day = False
    report = runs.run_full_refresh(ctx)
    want = bronze.all_orders(Context(spark, BenchmarkSources(spark, SMALL)))
    assert same(runs.bronze_orders(ctx), want)
    assert same(ctx.ref(runs.REVENUE_DAILY), gold.revenue_daily(want))
    assert report.steps[0].layer == "bronze"


def test_failing_test_fails_the_run(spark, tmp_path):
    ctx = Context(spark, BenchmarkSources(spark, SMALL), TableStore(spark, str(tmp_path)), run_at=RUN)
    checks = [*runs.CHECKS, Check("bronze.br_shopify_us_orders", "not_null", ("fulfillment_status",))]
    with pytest.raises(QualityError, match="fulfillment_status"):
        runs.run_daily(ctx, snapshots=False, checks=checks)


def test_failing_layer_stops_the_run(spark, tmp_path, monkeypatch):
    ctx = Context(spark, BenchmarkSources(spark, SMALL), TableStore(spark, str(tmp_path)), run_at=RUN)

    def broken(raw):
        raise RuntimeError("silver is broken")

    monkeypatch.setattr(silver, "customers", broken)
    with pytest.raises(RuntimeError, match="broken"):
        runs.run_daily(ctx, snapshots=False)
    assert ctx.tables.versions(runs.REVENUE_DAILY) == []


def test_change_batch_has_unique_keys(spark):
    raw = BenchmarkSources(spark, SMALL).scan_stores("orders")
    for df in (change_batch(raw), after_changes(raw)):
        assert df.count() == df.select("id").distinct().count()
    assert change_batch(raw).filter(F.col("id") < 0).count() > 0


def test_source_freshness_covers_all_declared_tables(spark):
    ctx = Context(spark, BenchmarkSources(spark, SMALL), run_at=datetime(2024, 1, 30, 20))
    got = {(r.source, r.table_name): r.status for r in runs.run_source_freshness(ctx).collect()}
    assert len(got) == 32
    assert got["src_ga4", "events"] == "pass"
    assert got["src_shopify_us", "orders"] == "error"
    assert got["src_salesforce", "lead"] == "error"


def test_a_run_makes_up_for_one_that_died_after_bronze(spark, tmp_path, monkeypatch):
    sources = BenchmarkSources(spark, SMALL)
    ctx = Context(spark, sources, TableStore(spark, str(tmp_path)), run_at=RUN)
    runs.run_daily(ctx, snapshots=False)
    sources.next_day = True
    with monkeypatch.context() as broken:
        broken.setattr(runs, "run_revenue_daily", None)
        with pytest.raises(TypeError):
            runs.run_daily(ctx, snapshots=False)
    runs.run_daily(ctx, snapshots=False)
    assert same(ctx.ref(runs.REVENUE_DAILY), gold.revenue_daily(runs.bronze_orders(ctx)))


def test_a_run_reads_no_table_again_for_what_was_counted_while_writing(lake, monkeypatch):
    ctx, *_ = lake
    monkeypatch.setattr(ctx.tables, "read_version", None)
    monkeypatch.setattr(ctx.tables, "read", None)
    counted = [c for c in runs.CHECKS if c.test == "not_null"]
    assert len(counted) == len(runs.ORDER_TABLES)
    assert {(r.table_name, r.failures, r.status) for r in runs.run_tests(ctx, counted).collect()} == {(t, 0, "pass") for t in runs.ORDER_TABLES}


def test_failures_counted_while_writing_equal_a_scan(spark, store):
    ctx = Context(spark, None, store, run_at=RUN)
    check = Check("bronze.seen", "not_null", ("v",))
    model = Model(
        "bronze.seen", lambda c: spark.range(100).selectExpr("id", "IF(id % 7 = 0, NULL, id) AS v", "date_add(date'2024-01-01', cast(id AS int)) AS day"),
        "table", layout=Layout("day"), tests=(check,),
    )
    run_model(ctx, model)
    unique = Check("bronze.seen", "unique", ("v",))
    found = {(r.test, r.failures) for r in runs.run_tests(ctx, [check, unique]).collect()}
    assert found == {("not_null", 15), ("unique", 0)}
    assert store.version("bronze.seen").failing == {"not_null v": ["2024-01", "2024-02", "2024-03", "2024-04"]}


def test_buckets_are_the_runs_to_choose(spark, tmp_path):
    ctx = Context(spark, BenchmarkSources(spark, SMALL), TableStore(spark, str(tmp_path)), run_at=RUN, buckets={runs.CUSTOMERS: 32, "gold.x": 3})
    run_model(ctx, runs.CUSTOMER_MODEL)
    first = ctx.tables.version(runs.CUSTOMERS)
    assert len(first.parts) == 32 and ctx.layout("gold.x", Layout("d")) == Layout("d")
    some = ctx.ref(runs.CUSTOMERS).orderBy("customer_id").limit(2).withColumn("updated_at", F.expr("timestamp'2030-01-01'"))
    again = replace(runs.CUSTOMER_MODEL, build=lambda c: some)
    run_model(ctx, again)
    now = ctx.tables.version(runs.CUSTOMERS)
    assert sum(first.parts[p] != w for p, w in now.parts.items()) <= 2
    assert ctx.ref(runs.CUSTOMERS).filter("updated_at = timestamp'2030-01-01'").count() == 2
