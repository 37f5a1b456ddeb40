"""The given benchmark tables seen as the raw tables of four stores.

The store of an order is that of its customer; the store of a customer follows
from the nation. All stores lie in one file per table, so ``scan_stores`` is
one scan, and ``scan`` of one store filters it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers import settings
from lakelayers.functions.expressions import store_currency
from lakelayers.sources.registry import require

STORES = tuple(settings.STORE_SOURCES)
STORE = f"element_at(array{STORES}, CAST(c_nationkey % {len(STORES)} + 1 AS int))"

# --- fixed values: the given tables' columns ---------------------------------
# Declared, so that planning a query opens no file.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class BenchmarkSources:
    """Raw orders, customers and events derived from the tables in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.next_day = False
        """Whether the orders of the following day have arrived."""

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def has(self, source: str, table: str) -> bool:
        require(source, table)
        if source == "src_ga4":
            return True
        stores = {*settings.STORE_SOURCES.values(), *settings.STORE_STREAM_SOURCES.values()}
        return source in stores and table in ("orders", "customers")

    def scan(self, source: str, table: str) -> DataFrame:
        require(source, table)
        if source == "src_ga4":
            return self.events()
        for store, name in [*settings.STORE_SOURCES.items(), *settings.STORE_STREAM_SOURCES.items()]:
            if source == name:
                return self.scan_stores(table).filter(F.col("platform") == store).drop("platform")
        raise LookupError(f"the given tables hold nothing for source {source}")

    def scan_stores(self, table: str) -> DataFrame:
        if table == "orders":
            return after_next_day(self._orders()) if self.next_day else self._orders()
        if table == "customers":
            return self._customers()
        raise LookupError(f"the given tables hold no store table {table}")

    def events(self) -> DataFrame:
        events = self.table("events")
        return events.withColumn("event_timestamp", F.col("ts").cast("timestamp")).drop("ts")

    def _orders(self) -> DataFrame:
        customer = self.table("customer").selectExpr("c_custkey", f"{STORE} AS platform")
        orders = self.table("orders")
        return (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .withColumn("currency", store_currency("platform"))
            .selectExpr(
                "o_orderkey AS id",
                "CAST(o_orderdate AS timestamp) AS created_at",
                f"{_hours_later('o_orderkey % 72')} AS updated_at",
                f"{_hours_later('o_orderkey % 24')} AS processed_at",
                "o_custkey AS customer_id",
                "concat('c', o_custkey, '@example.com') AS email",
                "CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'partially_paid' END "
                "AS financial_status",
                "CASE WHEN o_orderstatus = 'F' THEN 'fulfilled' END AS fulfillment_status",
                "struct(struct(CAST(o_totalprice AS string) AS amount, currency AS currency_code) AS shop_money) "
                "AS total_price_set",
                "currency",
                f"{_hours_later('o_orderkey % 72 + 1')} AS _fivetran_synced",
                "platform",
            )
        )

    def _customers(self) -> DataFrame:
        nation = self.table("nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS country")
        updated = "timestamp'2001-01-01' + make_dt_interval(CAST(c_custkey % 365 AS int))"
        return (
            self.table("customer")
            .join(nation, "c_nationkey", "left")
            .selectExpr(
                "c_custkey AS customer_id",
                "country",
                "c_acctbal AS balance",
                f"{updated} AS updated_at",
                f"{updated} + INTERVAL '1' HOUR AS _fivetran_synced",
                f"{STORE} AS platform",
            )
        )


def _hours_later(hours: str) -> str:
    return f"CAST(o_orderdate AS timestamp) + make_dt_interval(0, CAST({hours} AS int))"


def change_batch(orders: DataFrame) -> DataFrame:
    """Later changes to raw orders: refunds of a tenth, and some new orders.

    New orders take the negative of an existing key, which is free at any size.
    """
    key = F.col("id")
    refunds = orders.filter(key % 10 == 0).withColumns({
        "updated_at": F.col("updated_at") + F.expr("INTERVAL '10' YEAR"),
        "financial_status": F.lit("refunded"),
    })
    added = orders.filter(key % 100 == 1).withColumn("id", -key)
    return refunds.unionByName(added)


def after_changes(orders: DataFrame) -> DataFrame:
    """All raw orders once the change batch is in and some are deleted."""
    key = F.col("id")
    same = orders.filter((key % 10 != 0) & (key % 50 != 3))
    return same.unionByName(change_batch(orders))


def after_next_day(orders: DataFrame) -> DataFrame:
    """All raw orders a day on: the refunds and new orders of a change batch, all of them late."""
    late = change_batch(orders).withColumn("updated_at", F.greatest("updated_at", F.col("created_at") + F.expr("INTERVAL '10' YEAR")))
    return orders.filter(F.col("id") % 10 != 0).unionByName(late)


def redelivered(customers: DataFrame) -> DataFrame:
    """Raw customers with a fifth of them delivered once more, as they were a day before."""
    again = customers.filter(F.col("customer_id") % 5 == 0).withColumns({
        "updated_at": F.col("updated_at") - F.expr("INTERVAL '1' DAY"),
        "balance": F.col("balance") + F.lit(1000.0),
    })
    return customers.unionByName(again)
