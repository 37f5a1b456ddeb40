"""Silver models: one row per key, conformed across stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.operators.conform import join_dimension, latest_per_key, latest_sql

ORDER_KEYS = ("platform", "order_id")


def customers(raw: DataFrame) -> DataFrame:
    """The latest row of each store's customers."""
    columns = ["customer_id", "platform", "country", "balance", "updated_at"]
    return latest_per_key(raw.select(*columns), ["platform", "customer_id"], ["updated_at"])


def orders_enriched(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the country and balance of their customer, if known."""
    dim = customers.select(
        "platform", "customer_id", F.col("country").alias("customer_country"),
        F.col("balance").alias("customer_balance"),
    )
    return join_dimension(orders, dim, ["platform", "customer_id"])


def orders_enriched_sql(stored: Sequence[str], streamed: Sequence[str], customers: str, schema: T.StructType) -> str:
    """``orders_enriched`` over published views: orders of batch tables and, where a stream
    brings the same orders, the newest row of each, by the rule of ``latest_per_key``.
    ``schema`` is that of each of the order tables."""
    columns = ", ".join(f"`{c}`" for c in schema.names)
    orders = " UNION ALL ".join(f"SELECT {columns} FROM {t}" for t in [*stored, *streamed])
    if streamed:
        orders = latest_sql(f"({orders})", schema, ORDER_KEYS, ["updated_at"])
    return (
        "SELECT o.*, c.country AS customer_country, c.balance AS customer_balance "
        f"FROM ({orders}) o LEFT JOIN {customers} c ON o.platform = c.platform AND o.customer_id = c.customer_id"
    )
