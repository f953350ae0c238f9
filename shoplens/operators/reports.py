"""Metric reports: one labelled row per figure."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions import amount_text, exact_average, exact_sum
from shoplens.operators.kept import Totals
from shoplens.operators.traffic import is_client_error, is_server_error


def metric_rows(
    figures: DataFrame,
    metrics: Mapping[str, Column],
    label: str = "Metric",
    value: str = "Value",
) -> DataFrame:
    """Turn a one-row table of figures into a row per metric, in the given order."""
    rows = [
        F.struct(F.lit(name).alias(label), figure.alias(value))
        for name, figure in metrics.items()
    ]
    return figures.select(F.inline(F.array(*rows)))


def ecommerce_summary(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    currency: str | None = None,
) -> DataFrame:
    """(Metric, Value) as text: table sizes, revenue and average order value.

    Amounts are added as decimals, see ``functions.exact_sum``.
    """
    rows = F.count(F.lit(1)).alias("n")
    text = F.col("n").cast("string")
    order_figures = orders.agg(
        rows,
        exact_sum(F.col("totalAmount")).alias("revenue"),
        exact_average(F.col("totalAmount")).alias("average"),
    )
    return (
        metric_rows(customers.agg(rows), {"Total Customers": text})
        .unionByName(metric_rows(products.agg(rows), {"Total Products": text}))
        .unionByName(
            metric_rows(
                order_figures,
                {
                    "Total Orders": text,
                    "Total Revenue": amount_text(F.col("revenue"), currency),
                    "Average Order Value": amount_text(F.col("average"), currency),
                },
            )
        )
    )


def log_summary_of_totals(
    by_hour: Totals, by_page: Totals, by_ip: Totals
) -> DataFrame:
    """``log_summary`` from kept totals, without another pass over the requests."""
    requests = F.coalesce(F.sum("requests"), F.lit(0))
    client = F.coalesce(F.sum(F.when(is_client_error(), F.col("requests"))), F.lit(0))
    server = F.coalesce(F.sum(F.when(is_server_error(), F.col("requests"))), F.lit(0))
    counted = by_hour.table.agg(
        requests.alias("requests"), client.alias("client"), server.alias("server")
    )
    ips = by_ip.table.agg(F.count("ip").alias("n"))
    pages = by_page.table.select("endpoint").distinct().agg(F.count("endpoint").alias("n"))
    return (
        metric_rows(
            counted,
            {"Total Requests": F.col("requests"), "Valid Requests": F.col("requests")},
        )
        .unionByName(metric_rows(ips, {"Unique IPs": F.col("n")}))
        .unionByName(metric_rows(pages, {"Unique Pages": F.col("n")}))
        .unionByName(
            metric_rows(
                counted, {"4xx Errors": F.col("client"), "5xx Errors": F.col("server")}
            )
        )
    )


def log_summary(logs: DataFrame) -> DataFrame:
    """(Metric, Value) of parsed requests, in one pass.

    Both request totals count the parsed lines; see ``weblog_quality`` for the
    lines that did not parse.
    """
    figures = logs.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_distinct("ip").alias("ips"),
        F.count_distinct("endpoint").alias("pages"),
        F.count_if(is_client_error()).alias("client_errors"),
        F.count_if(is_server_error()).alias("server_errors"),
    )
    return metric_rows(
        figures,
        {
            "Total Requests": F.col("requests"),
            "Valid Requests": F.col("requests"),
            "Unique IPs": F.col("ips"),
            "Unique Pages": F.col("pages"),
            "4xx Errors": F.col("client_errors"),
            "5xx Errors": F.col("server_errors"),
        },
    )
