"""Whole runs: snapshots, then bronze, silver, gold, then the data tests.

Layers run in order and the first exception or failing test ends the run; what
was published before it stays.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers import settings
from lakelayers.context import Context
from lakelayers.operators import monitors, quality
from lakelayers.operators.conform import latest_per_key
from lakelayers.operators.history import snapshot
from lakelayers.operators.merge import merge
from lakelayers.operators.publish import Layout, Version, unit_of
from lakelayers.operators.quality import Check
from lakelayers.plans import bronze, gold, silver
from lakelayers.plans.models import Model, Outcome, run_model
from lakelayers.sources import seeds
from lakelayers.sources.registry import SOURCES

CUSTOMERS = "silver.silver_customers"
ORDERS_ENRICHED = "silver.silver_orders"
REVENUE_DAILY = "gold.gold_revenue_daily"
REVENUE_MONTHLY = "gold.gold_revenue_monthly"
SNAPSHOT = "snapshots.customers"
HISTORY = "mgt.metric_history"
SEEN_SCHEMAS = "mgt.seen_schemas"
PRODUCTS = "public.products"
DAY_LAYOUT = Layout("created_at_date", "month")


def store_model(store: str) -> Model:
    """Bronze orders of one store, merged by order."""
    name = f"bronze.br_{settings.STORE_SOURCES[store].removeprefix('src_')}_orders"
    return Model(
        name,
        lambda ctx: bronze.store_orders(ctx, store),
        "incremental",
        unique_key=("order_id",),
        layout=bronze.ORDER_LAYOUT,
        changed_on="updated_at",
        tests=(Check(name, "not_null", ("order_id",)),),
    )


STORE_MODELS = {store: store_model(store) for store in settings.STORE_SOURCES}
ORDER_TABLES = tuple(m.name for m in STORE_MODELS.values())
STREAM_TABLES = tuple(f"bronze.{source}_orders" for source in settings.STORE_STREAM_SOURCES.values())

PRODUCT_MODEL = Model(
    "bronze.products_with_tax", lambda ctx: bronze.products_with_tax(ctx.ref(PRODUCTS)), "table", inputs=(PRODUCTS,)
)
CUSTOMER_MODEL = Model(
    CUSTOMERS,
    lambda ctx: silver.customers(ctx.sources.scan_stores("customers")),
    "incremental",
    unique_key=("platform", "customer_id"),
    layout=Layout(keys=("platform", "customer_id"), buckets=settings.KEY_BUCKETS, mark="updated_at"),
    changed_on="updated_at",
)
# Not stored: a stored copy would have to be rebuilt whenever a customer changes.
ORDERS_MODEL = Model(
    ORDERS_ENRICHED,
    lambda ctx: silver.orders_enriched_sql(ORDER_TABLES, _streamed(ctx), CUSTOMERS, ctx.tables.version(ORDER_TABLES[0]).schema),
    "view",
)
# Months are sums of days, and there are far fewer days than orders.
MONTHLY_MODEL = Model(
    REVENUE_MONTHLY, lambda ctx: gold.roll_up_months(ctx.ref(REVENUE_DAILY)), "table", inputs=(REVENUE_DAILY,)
)

CHECKS: tuple[Check, ...] = (
    *(Check(t, "not_null", ("order_id",)) for t in ORDER_TABLES),
    *(Check(t, "unique", ("order_id",)) for t in ORDER_TABLES),
    Check(CUSTOMERS, "unique", ("platform", "customer_id")),
)


@dataclass
class Report:
    """What a run did, in order, and the results of its data tests."""

    steps: list[Outcome] = field(default_factory=list)
    tests: list = field(default_factory=list)


def run_daily(ctx: Context, snapshots: bool = True, checks: Sequence[Check] = CHECKS) -> Report:
    """Take in what is new since the last run."""
    return _run(ctx, snapshots, checks, full=False)


def run_full_refresh(ctx: Context, checks: Sequence[Check] = CHECKS) -> Report:
    """Rebuild every layer from the sources, whatever the tables hold."""
    return _run(ctx, False, checks, full=True)


def _run(ctx: Context, snapshots: bool, checks: Sequence[Check], full: bool) -> Report:
    report = Report()
    report.steps += run_seeds(ctx)
    if snapshots:
        report.steps.append(run_snapshots(ctx))
    report.steps += run_bronze(ctx, full)
    report.steps += [run_model(ctx, m, full) for m in (CUSTOMER_MODEL, ORDERS_MODEL)]
    report.steps.append(run_revenue_daily(ctx, full))
    report.steps.append(run_model(ctx, MONTHLY_MODEL, full))
    report.tests = quality.require_passing(run_tests(ctx, checks))
    ctx.tables.expire_all()
    return report


def run_seeds(ctx: Context) -> list[Outcome]:
    """Publish each seed whose file does not read as the table does."""
    outcomes = []
    for name, path in ctx.seeds.items():
        table, rows = f"public.{name}", seeds.read_seed(ctx.spark, path, seeds.SEED_TYPES[name])
        old = ctx.tables.version(table)
        if old is not None:
            stored = ctx.tables.read_version(table, old)
            if rows.exceptAll(stored).isEmpty() and stored.exceptAll(rows).isEmpty():
                outcomes.append(Outcome("public", table, old.number))
                continue
        outcomes.append(Outcome("public", table, ctx.tables.replace(table, rows).number))
    return outcomes


def run_snapshots(ctx: Context) -> Outcome:
    now = silver.customers(ctx.sources.scan_stores("customers"))
    v = snapshot(ctx.tables, SNAPSHOT, now, ["platform", "customer_id"], ctx.now, updated_at="updated_at")
    return Outcome("snapshots", SNAPSHOT, v.number)


def run_bronze(ctx: Context, full: bool) -> list[Outcome]:
    """The models do not depend on each other, so their jobs share the cluster."""
    models = [*STORE_MODELS.values(), *([PRODUCT_MODEL] if "products" in ctx.seeds else [])]
    with ThreadPoolExecutor(max_workers=len(models)) as pool:
        started = [pool.submit(inheritable_thread_target(ctx.spark)(run_model), ctx, m, full) for m in models]
    return [s.result() for s in started]


def _streamed(ctx: Context) -> list[str]:
    """The stream tables that there are."""
    return [t for t in STREAM_TABLES if ctx.tables.versions(t)]


def order_versions(ctx: Context) -> dict[str, Version]:
    return {t: ctx.tables.version(t) for t in [*ORDER_TABLES, *_streamed(ctx)]}


def bronze_orders(
    ctx: Context, versions: dict[str, Version] | None = None, months: list[str] | None = None
) -> DataFrame:
    """All stores' published bronze orders, or those of some months.

    Where a stream brings the same orders, the newer row of each. An order
    stays in the month of its creation, so months can be read by themselves.
    """
    versions = versions or order_versions(ctx)
    orders = monitors.union_all([
        ctx.tables.read_version(t, v, None if months is None else v.of_units(months)) for t, v in versions.items()
    ])
    if not set(versions) & set(STREAM_TABLES):
        return orders
    return latest_per_key(orders, silver.ORDER_KEYS, ["updated_at"])


def run_revenue_daily(ctx: Context, full: bool) -> Outcome:
    """Daily revenue, recomputed for the months whose bronze orders changed.

    A day belongs to one month, so no other month can change. What the stored
    version was made of is recorded with it, so a run that died after bronze
    is made up for by the next.
    """
    sources = order_versions(ctx)
    old = ctx.tables.version(REVENUE_DAILY)
    if full or old is None:
        daily = gold.revenue_daily(bronze_orders(ctx, sources))
        v = ctx.tables.replace(REVENUE_DAILY, daily, DAY_LAYOUT, sources=sources)
        return Outcome("gold", REVENUE_DAILY, v.number)
    months = sorted({unit_of(p) for p in old.stale_parts(sources)})
    if not months:
        return Outcome("gold", REVENUE_DAILY, old.number)
    daily = gold.revenue_daily(bronze_orders(ctx, sources, months))
    return Outcome("gold", REVENUE_DAILY, ctx.tables.replace_parts(REVENUE_DAILY, daily, months, sources).number)


def run_tests(ctx: Context, checks: Sequence[Check] = CHECKS) -> DataFrame:
    return quality.run_recorded(ctx.tables, checks, ctx.now)


def run_source_freshness(ctx: Context) -> DataFrame:
    """Status of every table of the declared sources that have limits."""
    results = []
    for limits in dict.fromkeys(s.limits for s in SOURCES.values() if s.limits):
        loads = [
            _last_load(ctx, s.name, table, s.loaded_at)
            for s in SOURCES.values() if s.limits == limits for table in s.tables
        ]
        results.append(monitors.source_freshness(monitors.union_all(loads), ctx.now, *limits))
    return monitors.union_all(results)


def _last_load(ctx: Context, source: str, table: str, loaded_at: str) -> DataFrame:
    """One row; a table that is not there counts as one without rows."""
    if ctx.sources.has(source, table):
        last = ctx.source(source, table).agg(F.max(loaded_at).cast("timestamp").alias("max_loaded_at"))
    else:
        last = ctx.spark.range(1).select(F.lit(None).cast("timestamp").alias("max_loaded_at"))
    return last.select(F.lit(source).alias("source"), F.lit(table).alias("table_name"), "max_loaded_at")


def run_monitors(ctx: Context) -> dict[str, DataFrame]:
    """All declared monitors over the published tables, by monitor name.

    Volume and mean monitors put a line into the metric history, one per run
    time however often it is run, and report whether it is out of line with the
    earlier ones. The schema monitor compares with the schema it saw last,
    whatever was published in between, and records the one it sees.
    """
    results, lines = {}, []
    for name, kind, table, column, minutes in settings.MONITORS:
        df = ctx.ref(table)
        if kind == "freshness":
            results[name] = _freshness(ctx, table, column, minutes)
        elif kind == "schema":
            results[name] = run_schema_monitor(ctx, table)
        elif kind == "volume":
            lines.append((name, table, "row_count", monitors.volume(df, table, ctx.now)))
        else:
            lines.append((name, table, f"mean {column}", monitors.mean(df, table, column, ctx.now)))
    merge(ctx.tables, HISTORY, monitors.union_all([line for *_, line in lines]), ["table_name", "metric", "run_at"], Layout("run_at"))
    flagged = monitors.flag_anomalies(ctx.ref(HISTORY))
    for name, table, metric, _ in lines:
        mine = (flagged.table_name == table) & (flagged.metric == metric)
        results[name] = flagged.filter(mine & (flagged.run_at == ctx.now))
    return results


def _freshness(ctx: Context, table: str, column: str, minutes: int) -> DataFrame:
    """Of a table whose mark the column is, the footers of the files are asked and no rows are read."""
    v = ctx.tables.version(table)
    if v is None or v.layout.mark != column:
        return monitors.table_freshness(ctx.ref(table), table, column, minutes, ctx.now)
    newest = ctx.tables.newest(table, v)
    last = F.lit(None).cast("timestamp") if newest is None else newest
    return monitors.freshness_line(ctx.spark.range(1).select(last.alias("last_at")), table, minutes, ctx.now)


def run_schema_monitor(ctx: Context, table: str) -> DataFrame:
    """Changes of a table's schema since this monitor last looked; none the first time."""
    now = ctx.tables.version(table).schema
    was = now
    if ctx.tables.versions(SEEN_SCHEMAS):
        seen = ctx.ref(SEEN_SCHEMAS).filter(F.col("table_name") == table).first()
        was = T.StructType.fromJson(json.loads(seen["schema"])) if seen else now
    line = ctx.spark.range(1).select(F.lit(table).alias("table_name"), F.lit(now.json()).alias("schema"), ctx.now.alias("seen_at"))
    merge(ctx.tables, SEEN_SCHEMAS, line, ["table_name"])
    return monitors.schema_changes(ctx.spark, was, now)
