"""Gold models: aggregates for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.functions.expressions import money_sum


def paid(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("financial_status") == "paid")


def revenue_daily(orders: DataFrame) -> DataFrame:
    """Paid orders and their revenue per day, store and currency."""
    return (
        paid(orders)
        .groupBy("created_at_date", "platform", "currency")
        .agg(F.count("*").alias("orders"), money_sum("total_price").alias("revenue"))
    )


def revenue_by_month(orders: DataFrame) -> DataFrame:
    """Revenue of paid orders per calendar month, store and currency."""
    return (
        paid(orders)
        .groupBy(F.date_trunc("month", "created_at").alias("month"), "platform", "currency")
        .agg(money_sum("total_price").alias("revenue"))
    )


def roll_up_months(daily: DataFrame) -> DataFrame:
    """Monthly revenue from the daily table."""
    return (
        daily.groupBy(F.date_trunc("month", "created_at_date").alias("month"), "platform", "currency")
        .agg(money_sum("revenue").alias("revenue"))
    )
