"""Exploration of the shop tables: distributions, statistics, business questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import exact_average
from shoplens.operators.profile import numeric_stats, share, top_groups, value_counts


def customers_by_segment(customers: DataFrame) -> DataFrame:
    return value_counts(customers, "customerSegment")


def top_countries(customers: DataFrame, k: int = 10) -> DataFrame:
    return value_counts(customers, "country", top=k)


def orders_by_status(orders: DataFrame) -> DataFrame:
    return value_counts(orders, "status")


def orders_by_payment(orders: DataFrame) -> DataFrame:
    """Orders per payment method; a missing method is a group of its own."""
    return value_counts(orders, "paymentMethod")


def products_by_category(products: DataFrame) -> DataFrame:
    return value_counts(products, "productCategory")


def order_amount_stats(orders: DataFrame) -> DataFrame:
    stats = numeric_stats(orders, ["totalAmount"])
    return stats.select(
        F.col("totalAmount_count").alias("Count"),
        F.col("totalAmount_sum").alias("Total_Sum"),
        F.round("totalAmount_min", 2).alias("Minimum"),
        F.round("totalAmount_max", 2).alias("Maximum"),
        F.col("totalAmount_avg").alias("Average"),
    )


def credit_by_segment(customers: DataFrame, count_rows: bool = False) -> DataFrame:
    """Credit limits per segment, best average first.

    ``Count`` leaves customers without a limit out, unless ``count_rows``.
    """
    counted = F.lit(1) if count_rows else F.col("creditLimit")
    return (
        customers.groupBy("customerSegment")
        .agg(
            F.count(counted).alias("Count"),
            F.round(exact_average(F.col("creditLimit")), 2).alias("Average_Credit"),
            F.round(F.max("creditLimit"), 2).alias("Max_Credit"),
        )
        .orderBy(F.desc("Average_Credit"), "customerSegment")
    )


def product_price_stats(products: DataFrame) -> DataFrame:
    stats = numeric_stats(products, ["buyPrice", "MSRP"])
    return stats.select(
        F.col("buyPrice_min").alias("min_buy"),
        F.col("buyPrice_max").alias("max_buy"),
        F.col("buyPrice_avg").alias("avg_buy"),
        F.col("MSRP_min").alias("min_msrp"),
        F.col("MSRP_max").alias("max_msrp"),
        F.col("MSRP_avg").alias("avg_msrp"),
    )


def top_credit_country(customers: DataFrame) -> DataFrame:
    return top_groups(customers, "country", "creditLimit", name="total_credit")


def top_order_status(orders: DataFrame) -> DataFrame:
    return value_counts(orders, "status", top=1)


def top_stock_category(products: DataFrame) -> DataFrame:
    return top_groups(products, "productCategory", "quantityInStock", name="total_stock")


def segment_share(customers: DataFrame, segment: str = "Enterprise") -> DataFrame:
    return share(customers, F.col("customerSegment") == segment)
