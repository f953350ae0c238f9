"""Explore the three shop tables and write the results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens import schemas
from shoplens.operators import customers as customer_ops
from shoplens.operators import orders as order_ops
from shoplens.operators import profile, reports, shop
from shoplens.sinks import write_dataset, write_report
from shoplens.sources import load_table, table_quality


def shop_figures(
    customers: DataFrame, products: DataFrame, orders: DataFrame
) -> dict[str, DataFrame]:
    """The analyses of a fixed number of rows, by name: metrics, top lists, months."""
    return {
        "row_counts": profile.row_counts(
            {"customers": customers, "products": products, "orders": orders}
        ),
        "null_counts_customers": profile.null_counts(customers),
        "null_counts_orders": profile.null_counts(orders),
        "duplicate_customers": profile.duplicate_keys(customers, "customerNumber"),
        "duplicate_orders": profile.duplicate_keys(orders, "orderNumber"),
        "top_countries": shop.top_countries(customers),
        "order_amount_stats": shop.order_amount_stats(orders),
        "product_price_stats": shop.product_price_stats(products),
        "top_credit_country": shop.top_credit_country(customers),
        "top_order_status": shop.top_order_status(orders),
        "top_stock_category": shop.top_stock_category(products),
        "segment_share": shop.segment_share(customers),
        "orders_by_month": order_ops.orders_by_month(orders),
        "order_size_distribution": order_ops.order_size_distribution(orders),
        "top_orders": order_ops.top_orders(orders),
        "summary": reports.ecommerce_summary(customers, products, orders),
    }


def shop_findings(
    customers: DataFrame, products: DataFrame, orders: DataFrame
) -> dict[str, DataFrame]:
    """The analyses with a row per key or per table row, by name."""
    return {
        "customers_by_segment": shop.customers_by_segment(customers),
        "orders_by_status": shop.orders_by_status(orders),
        "orders_by_payment": shop.orders_by_payment(orders),
        "products_by_category": shop.products_by_category(products),
        "credit_by_segment": shop.credit_by_segment(customers),
        "enterprise_with_upper": customer_ops.segment_customers(customers),
        "usa_customers": customer_ops.customers_in_country(customers),
        "shipped_orders": order_ops.shipped_orders(orders),
        "high_value_orders": order_ops.high_value_orders(orders),
        "orders_from_date": order_ops.orders_from_date(orders),
        "orders_in_status_list": order_ops.orders_in_status_list(orders),
        "large_order_flag": order_ops.large_order_flag(orders),
        "order_code": order_ops.order_code(orders),
    }


def run_shop_report(
    spark: SparkSession,
    customers_path: str,
    products_path: str,
    orders_path: str,
    output: str,
    sep: str = ",",
) -> list[str]:
    """Write every analysis below ``output`` and return their names.

    The CSV tables are copied to Parquet first: the analyses then read their
    own columns only, where each would parse whole CSV rows again. ``output`` must therefore be
    storage that all machines share. ``quality_<table>`` counts what did not fit the schemas.
    """
    tables, quality = {}, {}
    for name, path, schema in [
        ("customers", customers_path, schemas.CUSTOMERS),
        ("products", products_path, schemas.PRODUCTS),
        ("orders", orders_path, schemas.ORDERS),
    ]:
        copy = f"{output}/{name}.parquet"
        write_dataset(load_table(spark, path, schema, sep), copy)
        tables[name] = spark.read.schema(schema).parquet(copy)
        quality[f"quality_{name}"] = table_quality(spark, path, schema, sep)

    figures = shop_figures(**tables) | quality
    for name, figure in figures.items():
        write_report(figure, f"{output}/{name}")
    findings = shop_findings(**tables)
    for name, finding in findings.items():
        write_dataset(finding, f"{output}/{name}", format="csv")
    return [*figures, *findings]
