"""Every operator as a query over the given tables.

Each function takes ``(spark, folder)`` and gives a DataFrame. Timestamps come
out without a zone. Queries of operators that write publish their tables in a
new folder below the session's shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers import settings
from lakelayers.context import Context
from lakelayers.functions import expressions as x
from lakelayers.operators import conform, monitors, quality
from lakelayers.operators.history import snapshot
from lakelayers.operators.merge import merge
from lakelayers.operators.publish import ROWS_PER_FILE, Layout, TableStore, as_view, create_latest_version_view
from lakelayers.operators.quality import Check
from lakelayers.plans import bronze, gold, runs, silver
from lakelayers.plans.models import Model, run_model
from lakelayers.session import bytes_of, scratch_dir
from lakelayers.sources import seeds
from lakelayers.sources.benchmark import BenchmarkSources, after_changes, change_batch, redelivered
from lakelayers.sources.registry import ParquetSources
from lakelayers.streaming import ingest

ORDER_KEYS = ["platform", "order_id"]
LINE_KEYS = ["l_orderkey", "l_linenumber"]
FRESHNESS_NOW = datetime(2001, 8, 4, 12)
MONITOR_NOW = datetime(2002, 1, 1)
SNAPSHOT_RUN = datetime(2012, 1, 1)
TEST_DAY = datetime(2000, 1, 1)
INITIAL_LOAD_END = "1998-07-01"
SECOND_LOT, THIRD_LOT = datetime(2024, 1, 11), datetime(2024, 1, 21)
DELAY_HOURS = 12
ROW_BYTES = 512

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return zoneless(fn(Context(spark, BenchmarkSources(spark, folder))))

    QUERIES[fn.__name__] = run
    return run


def writing(run_at: datetime | None = None, catalog: bool = False) -> Callable:
    """A query with tables of its own to publish, in the catalog too if it reads them there."""

    def register(fn: Callable[[Context], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            store = TableStore(spark, scratch_dir(spark, fn.__name__), catalog=catalog)
            return zoneless(fn(Context(spark, BenchmarkSources(spark, folder), store, run_at=run_at)))

        QUERIES[fn.__name__] = run
        return run

    return register


def zoneless(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _at(moment: datetime) -> F.Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


# --- scans and expressions ---------------------------------------------------


@query
def scan_source_orders(ctx: Context) -> DataFrame:
    raw = ctx.source("src_shopify_us", "orders")
    return raw.select(
        "id", "created_at", "updated_at", "processed_at", "customer_id", "email", "financial_status",
        "fulfillment_status", F.col("total_price_set.shop_money.amount").cast("double").alias("amount"),
        F.col("total_price_set.shop_money.currency_code").alias("currency_code"), "currency", "_fivetran_synced",
    )


@query
def bronze_orders(ctx: Context) -> DataFrame:
    return bronze.store_orders(ctx, "yoga-us")


@query
def cents_to_dollars(ctx: Context) -> DataFrame:
    lines = ctx.sources.table("lineitem")
    return lines.select(*LINE_KEYS, x.cents_to_dollars("l_extendedprice").alias("dollars"),
                        x.cents_to_dollars("l_extendedprice", scale=1).alias("dollars_1"))


@query
def case_map_status(ctx: Context) -> DataFrame:
    orders = bronze.all_orders(ctx)
    groups = {"paid": "closed", "pending": "open"}
    return orders.select(
        "order_id", "financial_status", "fulfillment_status",
        x.case_map("financial_status", groups).alias("payment_group"),
        x.case_map("fulfillment_status", {"fulfilled": "shipped"}, "waiting").alias("shipping_group"),
    )


@query
def platform_dims(ctx: Context) -> DataFrame:
    orders = bronze.all_orders(ctx)
    return orders.select("order_id", "platform", x.store_currency("platform").alias("platform_currency"),
                         x.store_code("platform").alias("platform_code"))


@query
def seed_products(ctx: Context) -> DataFrame:
    return _padded_seed(ctx)


@query
def products_with_tax(ctx: Context) -> DataFrame:
    return bronze.products_with_tax(_part_products(ctx))


def _part_products(ctx: Context) -> DataFrame:
    part = ctx.sources.table("part")
    return part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                       F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"))


def _written_seed(ctx: Context) -> str:
    path = scratch_dir(ctx.spark, "seed_products")
    seeds.write_padded(_part_products(ctx), path)
    return path


def _padded_seed(ctx: Context, types: dict[str, str] | None = None) -> DataFrame:
    return seeds.read_seed(ctx.spark, _written_seed(ctx), seeds.SEED_TYPES["products"], types)


@query
def seed_column_types(ctx: Context) -> DataFrame:
    seed = _padded_seed(ctx, {"product_id": "string", "price": "decimal(10,2)"})
    return seed.select("product_id", F.col("price").cast("double").alias("price"))


@query
def cutoff_filter(ctx: Context) -> DataFrame:
    ctx.vars = {"retention_date": "1998-12-30"}
    recent = conform.from_cutoff(bronze.all_orders(ctx), "created_at_date", ctx.cutoff("retention_date"))
    return recent.select("order_id", "platform", "created_at_date")


@query
def cutoff_events(ctx: Context) -> DataFrame:
    ctx.vars = {"retention_date": "2024-01-16"}
    kept = conform.from_cutoff(ctx.source("src_ga4", "events"), "event_timestamp", ctx.cutoff("retention_date"))
    return kept.select("event_id", "event_timestamp", "event_type")


@query
def local_business_date(ctx: Context) -> DataFrame:
    orders = bronze.all_orders(ctx)
    return orders.select("order_id", "processed_at", x.local_time("processed_at").alias("local_processed_at"),
                         x.local_date("processed_at").alias("local_processed_date"))


# --- conforming -----------------------------------------------------------------


@query
def union_stores(ctx: Context) -> DataFrame:
    raw = conform.union_stores(settings.STORE_SOURCES, lambda source: ctx.source(source, "orders"))
    return bronze.orders(raw, F.col("platform"))


@writing()
def stream_store_union(ctx: Context) -> DataFrame:
    """The customer streams of all stores as one stream, written as it comes."""
    root = ctx.tables.root
    raw = {source: ctx.source(source, "customers") for source in settings.STORE_STREAM_SOURCES.values()}
    streams = ParquetSources(ctx.spark, f"{root}/_raw", {(source, "customers"): df.schema for source, df in raw.items()})
    with ThreadPoolExecutor(max_workers=len(raw)) as pool:
        list(pool.map(inheritable_thread_target(ctx.spark)(lambda s: raw[s].write.parquet(streams.path(s, "customers"))), raw))
    stream = conform.union_stores(settings.STORE_STREAM_SOURCES, lambda source: streams.stream(source, "customers"))
    stream = stream.select("customer_id", "platform", "country", "balance", "updated_at")
    ingest.append_files(stream, f"{root}/_out", f"{root}/_checkpoint").awaitTermination()
    return ctx.spark.read.schema(stream.schema).parquet(f"{root}/_out")


@query
def silver_dedup(ctx: Context) -> DataFrame:
    return conform.latest_per_key(ctx.sources.table("lineitem"), LINE_KEYS, ["l_shipdate"])


@query
def silver_customers(ctx: Context) -> DataFrame:
    return silver.customers(redelivered(ctx.sources.scan_stores("customers")))


@writing()
def silver_orders_enriched(ctx: Context) -> DataFrame:
    ctx.tables.replace(runs.CUSTOMERS, silver.customers(ctx.sources.scan_stores("customers")))
    return silver.orders_enriched(bronze.all_orders(ctx), ctx.ref(runs.CUSTOMERS))


@query
def revenue_by_month(ctx: Context) -> DataFrame:
    return gold.revenue_by_month(bronze.all_orders(ctx))


@query
def gold_revenue_daily(ctx: Context) -> DataFrame:
    return gold.revenue_daily(bronze.all_orders(ctx))


# --- incremental ----------------------------------------------------------------


@query
def high_water_mark(ctx: Context) -> DataFrame:
    return conform.high_water_marks(bronze.all_orders(ctx), "platform", "updated_at")


@writing()
def stored_high_water_mark(ctx: Context) -> DataFrame:
    """Each store's newest order as the footers of its published table's files tell it."""
    marks = []
    for store, model in runs.STORE_MODELS.items():
        ctx.tables.replace(model.name, bronze.store_orders(ctx, store), model.layout)
        newest = ctx.tables.newest(model.name, ctx.tables.version(model.name))
        marks.append(ctx.spark.range(1).select(F.lit(store).alias("platform"), newest.alias("high_water")))
    return monitors.union_all(marks)


@query
def incremental_filter(ctx: Context) -> DataFrame:
    orders = bronze.all_orders(ctx)
    loaded = orders.filter(F.col("created_at_date") < F.lit(INITIAL_LOAD_END).cast("date"))
    return conform.changed_rows(orders, loaded, "updated_at")


@query
def incremental_lookback(ctx: Context) -> DataFrame:
    orders = bronze.all_orders(ctx)
    loaded = orders.filter(F.col("created_at_date") < F.lit(INITIAL_LOAD_END).cast("date"))
    return conform.changed_rows(orders, loaded, "updated_at", timedelta(days=2)).select("order_id", "updated_at")


def _first_load(ctx: Context, name: str) -> None:
    ctx.tables.replace(name, bronze.all_orders(ctx), bronze.ORDER_LAYOUT)


def _changes(ctx: Context) -> DataFrame:
    return bronze.orders(change_batch(ctx.sources.scan_stores("orders")), F.col("platform"))


@writing()
def incremental_merge(ctx: Context) -> DataFrame:
    name = "bronze.orders"
    _first_load(ctx, name)
    merge(ctx.tables, name, _changes(ctx), ORDER_KEYS)
    return ctx.ref(name)


@writing()
def full_refresh(ctx: Context) -> DataFrame:
    name = "bronze.orders"
    _first_load(ctx, name)
    merge(ctx.tables, name, _changes(ctx), ORDER_KEYS)
    _first_load(ctx, name)
    return ctx.ref(name)


@writing()
def table_rebuild(ctx: Context) -> DataFrame:
    name = "bronze.products_with_tax"
    ctx.tables.replace(name, _part_products(ctx).withColumn("price_with_tax", F.col("price")))
    ctx.tables.replace(name, bronze.products_with_tax(ctx.ref(name).drop("price_with_tax")))
    return ctx.ref(name)


@writing(catalog=True)
def view_model(ctx: Context) -> DataFrame:
    ctx.tables.replace("gold.days_of_view", gold.revenue_daily(bronze.all_orders(ctx)))
    sql = "SELECT platform, sum(orders) AS orders, count(*) AS days FROM gold.days_of_view GROUP BY platform"
    return as_view(ctx.spark, "gold.platforms_by_view", sql)


@writing(catalog=True)
def view_of_view(ctx: Context) -> DataFrame:
    """Gold over a silver view model, after its inputs have moved on: batch orders, and a
    stream that brings newer rows, older ones, ties and orders without a key."""
    ctx.tables.replace("silver.customers_of_view", silver.customers(ctx.sources.scan_stores("customers")))
    _first_load(ctx, "bronze.orders_of_view")
    ctx.tables.replace("bronze.streamed_of_view", _streamed_again(bronze.all_orders(ctx)), bronze.STREAM_LAYOUT)
    schema = ctx.tables.version("bronze.orders_of_view").schema
    sql = silver.orders_enriched_sql(["bronze.orders_of_view"], ["bronze.streamed_of_view"], "silver.customers_of_view", schema)
    run_model(ctx, Model("silver.orders_view", lambda c: sql, "view"))
    merge(ctx.tables, "bronze.orders_of_view", _changes(ctx), ORDER_KEYS)
    return ctx.ref("silver.orders_view").groupBy("customer_country", "financial_status").agg(
        F.count("*").alias("orders"), x.money_sum("total_price").alias("revenue")
    )


def _streamed_again(orders: DataFrame) -> DataFrame:
    """Some of one store's orders: newer (5), tied and smaller (6), tied and greater (7), without a key (8), older (9)."""
    digit, day = F.col("order_id") % 10, F.expr("INTERVAL '1' DAY")
    status = {5: "streamed", 6: "aaa", 7: "zzz", 8: "keyless", 9: "stale"}
    rows = orders.filter((F.col("platform") == "yoga-us") & digit.isin(*status))
    return rows.withColumns({
        "updated_at": F.when(digit == 5, F.col("updated_at") + day).when(digit == 9, F.col("updated_at") - day).otherwise(F.col("updated_at")),
        "financial_status": x.case_map(digit.cast("string"), {str(k): v for k, v in status.items()}),
        "order_id": F.when(digit != 8, F.col("order_id")),
    })


@writing(catalog=True)
def latest_version_view(ctx: Context) -> DataFrame:
    name = "bronze.orders_by_view"
    _first_load(ctx, name)
    create_latest_version_view(ctx.spark, name, "bronze.orders_latest")
    merge(ctx.tables, name, _changes(ctx), ORDER_KEYS)
    latest = ctx.spark.table("bronze.orders_latest").select("order_id", "platform", "financial_status", "updated_at")
    # Planned over the version of now; what is published after it must not take its files away.
    for _ in range(3):
        merge(ctx.tables, name, _changes(ctx).filter("order_id < 0").withColumn("financial_status", F.lit("gone")), ORDER_KEYS)
        ctx.tables.expire_all()
    return latest


@writing(catalog=True)
def preview_rows(ctx: Context) -> DataFrame:
    ctx.tables.replace("bronze.orders_to_look_at", bronze.all_orders(ctx))
    found = ctx.preview("bronze.orders_to_look_at", 20, ["order_id", "platform"])
    return found.select("order_id", "platform", "financial_status", "total_price")


@writing()
def clustered_layout(ctx: Context) -> DataFrame:
    name = "bronze.orders"
    _first_load(ctx, name)
    february = ctx.tables.read(name, dates=(date(1998, 2, 1), date(1998, 2, 28)))
    return february.select("order_id", "created_at_date", "total_price")


@writing()
def part_files(ctx: Context) -> DataFrame:
    """Rows of each month that a write of many tasks leaves behind, and whether its files
    are as many as their bounds ask for: a task's share of the shuffle, and rows."""
    ctx.tables.replace("bronze.orders", bronze.all_orders(ctx).repartition(8), bronze.ORDER_LAYOUT)
    stored = ctx.ref("bronze.orders").select(F.date_format("created_at_date", "yyyy-MM").alias("month"), F.input_file_name().alias("file"))
    files = stored.groupBy("month", "file").agg(F.count("*").alias("rows"))
    by_month = files.groupBy("month").agg(F.sum("rows").alias("orders"), F.count("*").alias("files"), F.max("rows").alias("most"))
    share = bytes_of(ctx.spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    # Run-time splitting cuts a month by the bytes its rows have in the shuffle: at most ROW_BYTES each.
    allowed = 1 + F.ceil(F.col("orders") * ROW_BYTES * 2 / share) + F.ceil(F.col("orders") / ROWS_PER_FILE)
    return by_month.select("month", "orders", ((F.col("files") <= allowed) & (F.col("most") <= ROWS_PER_FILE)).alias("files_bounded"))


@writing()
def scd2_snapshot(ctx: Context) -> DataFrame:
    """Orders as they were, after the changes, and once the deleted ones are back as they were."""
    name = "snapshots.orders"
    raw = ctx.sources.scan_stores("orders")
    back = after_changes(raw).unionByName(raw.filter("id % 10 <> 0 AND id % 50 = 3"))
    for n, state in enumerate((raw, after_changes(raw), back)):
        rows = bronze.orders(state, F.col("platform")).select(*ORDER_KEYS, "financial_status", "total_price", "updated_at")
        snapshot(ctx.tables, name, rows, ORDER_KEYS, _at(SNAPSHOT_RUN + timedelta(days=n - 1)), updated_at="updated_at")
    return ctx.ref(name)


@writing()
def scd2_check_columns(ctx: Context) -> DataFrame:
    name = "snapshots.orders"
    raw = ctx.sources.scan_stores("orders")
    for state, run_at in ((raw, datetime(2011, 1, 1)), (after_changes(raw), SNAPSHOT_RUN)):
        rows = bronze.orders(state, F.col("platform")).select(*ORDER_KEYS, "financial_status")
        snapshot(ctx.tables, name, rows, ORDER_KEYS, _at(run_at), check=["financial_status"])
    return ctx.ref(name)


# --- quality -----------------------------------------------------------------------


@query
def dq_not_null(ctx: Context) -> DataFrame:
    return quality.not_null(bronze.all_orders(ctx), "fulfillment_status").select("order_id", "fulfillment_status")


@query
def dq_unique(ctx: Context) -> DataFrame:
    return quality.unique(ctx.sources.table("lineitem"), *LINE_KEYS)


@query
def dq_is_valid_date(ctx: Context) -> DataFrame:
    return quality.is_valid_date(bronze.all_orders(ctx), "created_at_date", _at(TEST_DAY))


@query
def dq_non_negative(ctx: Context) -> DataFrame:
    return quality.non_negative(ctx.sources.scan_stores("customers"), "balance")


@query
def dq_summary(ctx: Context) -> DataFrame:
    frames = {
        "orders": bronze.all_orders(ctx),
        "customers": ctx.sources.scan_stores("customers"),
        "lineitem": ctx.sources.table("lineitem"),
    }
    checks = [
        Check("orders", "not_null", ("order_id",)),
        Check("orders", "unique", ("order_id",)),
        Check("orders", "not_null", ("fulfillment_status",)),
        Check("orders", "is_valid_date", ("created_at_date",)),
        Check("orders", "non_negative", ("total_price",)),
        Check("customers", "not_null", ("customer_id",)),
        Check("customers", "non_negative", ("balance",)),
        Check("lineitem", "unique", tuple(LINE_KEYS)),
    ]
    return quality.run_checks(ctx.spark, frames, checks, _at(TEST_DAY))


# --- monitors ------------------------------------------------------------------------


@query
def source_freshness(ctx: Context) -> DataFrame:
    ctx.run_at = FRESHNESS_NOW
    return runs.run_source_freshness(ctx)


@query
def monitor_freshness(ctx: Context) -> DataFrame:
    orders = bronze.all_orders(ctx)
    frames = {
        "bronze.br_shopify_us_orders": bronze.store_orders(ctx),
        "silver.silver_customers": silver.customers(ctx.sources.scan_stores("customers")),
        "gold.gold_revenue_daily": gold.paid(orders),
    }
    return monitors.union_all([
        monitors.table_freshness(frames[table], table, column, minutes, _at(MONITOR_NOW))
        for _, kind, table, column, minutes in settings.MONITORS if kind == "freshness"
    ])


@query
def monitor_volume(ctx: Context) -> DataFrame:
    return monitors.union_all([
        monitors.volume(bronze.store_orders(ctx, store), runs.STORE_MODELS[store].name, _at(MONITOR_NOW)) for store in runs.STORE_MODELS
    ])


@query
def monitor_metric_mean(ctx: Context) -> DataFrame:
    return monitors.union_all([
        monitors.mean(bronze.store_orders(ctx, store), runs.STORE_MODELS[store].name, "total_price", _at(MONITOR_NOW))
        for store in runs.STORE_MODELS
    ])


@query
def monitor_anomaly(ctx: Context) -> DataFrame:
    orders = bronze.all_orders(ctx)
    value = {"row_count": F.count("*").cast("double"), "mean total_price": x.money_mean("total_price")}
    days = orders.groupBy("created_at_date").agg(*[v.alias(m) for m, v in value.items()])
    lines = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("metric_value")) for m in value])
    history = days.select(
        F.lit("bronze.orders").alias("table_name"), F.col("created_at_date").cast("timestamp").alias("run_at"),
        F.inline(lines),
    )
    return monitors.flag_anomalies(history).select("metric", "run_at", "baseline_runs", "is_anomaly")


@writing(run_at=MONITOR_NOW)
def monitor_schema(ctx: Context) -> DataFrame:
    """What changed since the monitor looked, two versions ago."""
    name = runs.REVENUE_DAILY
    daily = gold.revenue_daily(bronze.all_orders(ctx))
    before = daily.withColumn("note", F.lit("")).withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))
    ctx.tables.replace(name, before.drop("orders"))
    runs.run_schema_monitor(ctx, name)
    ctx.tables.replace(name, daily)
    ctx.tables.replace(name, daily.filter("orders > 1"))
    changes = runs.run_schema_monitor(ctx, name)
    return changes.withColumn("table_rows", F.lit(ctx.ref(name).count()).cast("bigint"))


# --- streams -----------------------------------------------------------------------------


@writing()
def stream_dedup_events(ctx: Context) -> DataFrame:
    """Three deliveries: later events first, then copies, then early events that are new."""
    name, events = "bronze.events", ctx.sources.table("events")
    drop, checkpoint = f"{ctx.tables.root}/_drop", f"{ctx.tables.root}/_checkpoint"
    late = F.col("event_id") % 7 == 0
    for delivery in (events.filter(~late), events.filter(F.col("event_id") % 10 == 0), events.filter(late)):
        delivery.write.mode("append").parquet(drop)
        stream = ctx.spark.readStream.schema(events.schema).parquet(drop)
        layout = ctx.layout(name, Layout("ts", "month", ("event_id",), settings.KEY_BUCKETS))
        ingest.take_in(stream, ctx.tables, name, ["event_id"], "ts", checkpoint, layout).awaitTermination()
    return ctx.ref(name)


@writing()
def stream_first_arrivals(ctx: Context) -> DataFrame:
    """Events behind a watermark, in three deliveries, with the number of rows that came too late.

    The second one brings copies of the first: as they were, moved within the delay, and
    moved far beyond it, which count as new. The third brings events held back
    until then, most of which are too late.
    """
    events, at = ctx.sources.table("events"), F.col("ts")
    held = (F.col("event_id") % 7 == 0) & (at < _ntz(THIRD_LOT))
    prompt = events.filter(~held)
    first = prompt.filter(at < _ntz(SECOND_LOT))
    drop, out = f"{ctx.tables.root}/_drop", f"{ctx.tables.root}/_out"
    too_late = 0

    def moved(rows: DataFrame, hours: int) -> DataFrame:
        return rows.withColumn("ts", at + F.expr(f"INTERVAL '{hours}' HOUR"))

    newest = first.agg(F.max("ts")).first()[0]
    mark = newest - timedelta(hours=DELAY_HOURS)
    copies = [
        first.filter("event_id % 10 = 0"),
        moved(first.filter((F.col("event_id") % 10 == 3) & (at > _ntz(mark + timedelta(seconds=1)))), 1),
        moved(first.filter((F.col("event_id") % 10 == 5) & (at < _ntz(mark - timedelta(days=2)))), 240),
    ]
    second = monitors.union_all([prompt.filter((at >= _ntz(SECOND_LOT)) & (at < _ntz(THIRD_LOT))), *copies])
    for delivery in (first, second, events.filter(held | (at >= _ntz(THIRD_LOT)))):
        delivery.write.mode("append").parquet(drop)
        stream = ctx.spark.readStream.schema(events.schema).parquet(drop)
        seen = ingest.first_arrivals(stream, out, f"{ctx.tables.root}/_checkpoint", ["event_id"], "ts", f"{DELAY_HOURS} hours")
        too_late += seen.too_late
    kept = ctx.spark.read.parquet(out)
    return kept.withColumn("too_late", F.lit(too_late).cast("bigint"))


def _ntz(moment: datetime) -> F.Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


@writing()
def stream_upsert_orders(ctx: Context) -> DataFrame:
    """Orders of the store that has most, delivered to its stream in two lots."""
    store, source = "yoga-us", settings.STORE_STREAM_SOURCES["yoga-us"]
    raw = ctx.source(source, "orders")
    streams = ParquetSources(ctx.spark, f"{ctx.tables.root}/_raw", {(source, "orders"): raw.schema})
    streaming = Context(ctx.spark, streams, ctx.tables)
    for delivery in (raw, change_batch(raw)):
        delivery.write.mode("append").parquet(streams.path(source, "orders"))
        ingest.upsert_store(streaming, store, "orders", f"{ctx.tables.root}/_checkpoints").awaitTermination()
    return ctx.ref(f"bronze.{source}_orders")


@writing(run_at=MONITOR_NOW)
def stream_and_batch_orders(ctx: Context) -> DataFrame:
    """One store's orders by stream and by batch: the batch brings rows older than the
    stream's newest, and stale copies of what the stream has changed."""
    store, source = "yoga-us", settings.STORE_STREAM_SOURCES["yoga-us"]
    raw = ctx.source(settings.STORE_SOURCES[store], "orders")
    changed = change_batch(raw)
    streams = ParquetSources(ctx.spark, f"{ctx.tables.root}/_raw", {(source, "orders"): raw.schema})
    changed.write.parquet(streams.path(source, "orders"))
    ingest.upsert_store(Context(ctx.spark, streams, ctx.tables), store, "orders", f"{ctx.tables.root}/_checkpoints").awaitTermination()
    for model in runs.STORE_MODELS.values():
        run_model(ctx, model)
    # Delivered again, as they were before the stream's changes.
    merge(ctx.tables, runs.STORE_MODELS[store].name, bronze.orders(raw.filter("id % 5 = 0"), store), ["order_id"], newer_by="updated_at")
    return runs.bronze_orders(ctx)


# --- whole runs ----------------------------------------------------------------------------


@writing(run_at=MONITOR_NOW, catalog=True)
def daily_run(ctx: Context) -> DataFrame:
    """Two days; on the second, refunds and new orders have arrived."""
    ctx.seeds = {"products": _written_seed(ctx)}
    runs.run_daily(ctx)
    ctx.sources.next_day = True
    ctx.run_at += timedelta(days=1)
    runs.run_daily(ctx)
    return ctx.ref(runs.REVENUE_DAILY)


@writing(run_at=MONITOR_NOW, catalog=True)
def full_refresh_run(ctx: Context) -> DataFrame:
    runs.run_daily(ctx, snapshots=False)
    runs.run_full_refresh(ctx)
    return ctx.ref(runs.REVENUE_MONTHLY)
