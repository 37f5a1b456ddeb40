"""Bronze models: raw tables with clean names and types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers import settings
from lakelayers.context import Context
from lakelayers.functions.expressions import cents_to_dollars, price_with_tax
from lakelayers.operators.publish import Layout

# Orders of all stores and both ways of delivery are split by month of creation,
# which does not change over an order's life; revenue is split alike.
ORDER_LAYOUT = Layout("created_at_date", "month", mark="updated_at")
# A stream's small batches rewrite a bucket of a month, and read the buckets of their orders.
STREAM_LAYOUT = Layout("created_at_date", "month", ("order_id",), settings.KEY_BUCKETS)
CUSTOMER_STREAM_LAYOUT = Layout(keys=("customer_id",), buckets=settings.KEY_BUCKETS)


def orders(raw: DataFrame, platform: Column | str) -> DataFrame:
    """The twelve bronze order columns of raw store orders."""
    platform = F.lit(platform) if isinstance(platform, str) else platform
    return raw.select(
        F.col("id").alias("order_id"),
        F.col("created_at").cast("timestamp").alias("created_at"),
        F.to_date("created_at").alias("created_at_date"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
        F.col("processed_at").cast("timestamp").alias("processed_at"),
        "customer_id",
        "email",
        "financial_status",
        "fulfillment_status",
        cents_to_dollars("total_price_set.shop_money.amount").alias("total_price"),
        "currency",
        platform.alias("platform"),
    )


def store_orders(ctx: Context, store: str = "yoga-us") -> DataFrame:
    """Bronze orders of one store."""
    return orders(ctx.source(settings.STORE_SOURCES[store], "orders"), store)


def all_orders(ctx: Context) -> DataFrame:
    """Bronze orders of all stores."""
    return orders(ctx.sources.scan_stores("orders"), F.col("platform"))


def products_with_tax(products: DataFrame) -> DataFrame:
    return products.withColumn("price_with_tax", price_with_tax("price"))
