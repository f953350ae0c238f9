"""Order pipelines."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order_date() -> Column:
    # Free on a date column; reads an ISO text as a date, else null.
    return F.col("orderDate").try_cast("date")


def orders_by_month(orders: DataFrame) -> DataFrame:
    """Orders per month of the year; the same month of all years is one group."""
    return (
        orders.groupBy(F.month(_order_date()).cast("bigint").alias("Month"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("Month")
    )


def high_value_orders(orders: DataFrame, cut: float = 5000) -> DataFrame:
    return orders.where(F.col("totalAmount") > cut)


def order_projection(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("orderNumber").alias("id"),
        F.col("orderDate").alias("date"),
        F.col("totalAmount").alias("amount"),
        "status",
    )


def order_size(orders: DataFrame, cuts: tuple[float, float] = (1000, 5000)) -> DataFrame:
    """Add ``orderSize``; an order without an amount counts as Large."""
    small, large = cuts
    amount = F.col("totalAmount")
    return orders.withColumn(
        "orderSize",
        F.when(amount < small, "Small").when(amount < large, "Medium").otherwise("Large"),
    )


def order_size_distribution(
    orders: DataFrame, cuts: tuple[float, float] = (1000, 5000)
) -> DataFrame:
    return (
        order_size(orders, cuts)
        .groupBy("orderSize")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("orderSize")
    )


def shipped_orders(
    orders: DataFrame, cuts: tuple[float, float] = (2000, 5000), status: str = "Shipped"
) -> DataFrame:
    """Shipped orders with the amount in whole units and a priority."""
    medium, high = cuts
    amount = F.col("totalAmount")
    priority = F.when(amount > high, "High").when(amount > medium, "Medium").otherwise("Low")
    return orders.where(F.col("status") == status).select(
        "orderNumber",
        "orderDate",
        F.round(amount, 0).alias("amountRounded"),
        priority.alias("priority"),
        "status",
    )


def orders_reduced(
    orders: DataFrame, dropped: Sequence[str] = ("requiredDate", "paymentMethod")
) -> DataFrame:
    return orders.drop(*dropped)


def orders_from_date(
    orders: DataFrame, first: datetime.date = datetime.date(2024, 6, 1)
) -> DataFrame:
    return orders.where(_order_date() >= F.lit(first))


def large_order_flag(orders: DataFrame, cut: float = 3000) -> DataFrame:
    return orders.withColumn("isLargeOrder", F.col("totalAmount") > cut)


def orders_in_status_list(
    orders: DataFrame, statuses: Sequence[str] = ("Processing", "Shipped")
) -> DataFrame:
    return orders.where(F.col("status").isin(*statuses))


def order_code(orders: DataFrame, width: int = 5) -> DataFrame:
    """Add ``orderCode``, the number padded with zeros to at least ``width`` digits.

    Longer numbers stay whole, so that a code names one order.
    """
    number = F.col("orderNumber").cast("string")
    digits = F.when(F.length(number) >= width, number).otherwise(F.lpad(number, width, "0"))
    return orders.withColumn("orderCode", F.concat(F.lit("ORDER-"), digits))


def top_orders(orders: DataFrame, k: int = 10) -> DataFrame:
    return orders.orderBy(F.desc("totalAmount"), "orderNumber").limit(k)
