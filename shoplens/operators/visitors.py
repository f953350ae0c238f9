"""Behaviour per address: activity, bots, bounces, funnels, abuse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from shoplens.functions import percentage
from shoplens.operators.kept import Totals
from shoplens.operators.reports import metric_rows


class AddressTotals(Totals):
    """(ip, request_count, requests_404), as ``ip_totals`` gives them."""


def ip_totals(logs: DataFrame | AddressTotals) -> AddressTotals:
    """Requests of each address; several analyses start from this table and take it for logs.

    Persist it before running more than one of them on the same logs.
    """
    if isinstance(logs, AddressTotals):
        return logs
    return AddressTotals(
        logs.groupBy("ip").agg(
            F.count(F.lit(1)).alias("request_count"),
            F.count_if(F.col("status") == 404).alias("requests_404"),
        )
    )


def requests_per_ip(logs: DataFrame | AddressTotals) -> DataFrame:
    return ip_totals(logs).table.select("ip", "request_count")


def top_ips(logs: DataFrame | AddressTotals, k: int = 10) -> DataFrame:
    return requests_per_ip(logs).orderBy(F.desc("request_count"), "ip").limit(k)


def requests_per_ip_stats(logs: DataFrame | AddressTotals) -> DataFrame:
    requests = F.col("request_count")
    return requests_per_ip(logs).agg(
        F.count(requests).alias("count"),
        F.round(F.avg(requests), 2).alias("mean"),
        F.round(F.stddev_samp(requests), 2).alias("stddev"),
        F.min(requests).alias("min"),
        F.max(requests).alias("max"),
    )


def bot_ips(logs: DataFrame | AddressTotals, threshold: int = 100) -> DataFrame:
    return (
        requests_per_ip(logs)
        .where(F.col("request_count") > threshold)
        .orderBy(F.desc("request_count"), "ip")
    )


def bounce_rate(logs: DataFrame | AddressTotals, per: Column | None = None) -> DataFrame:
    """(unique_ips, bounced_ips, bounce_rate): addresses with exactly one request.

    With ``per``, such as a day, one such row for each of its values; that takes requests.
    """
    if per is None:
        visits, period = requests_per_ip(logs), []
    else:
        period = ["period"]
        visits = logs.groupBy(per.alias("period"), "ip").agg(
            F.count(F.lit(1)).alias("request_count")
        )
    counted = visits.groupBy(*period).agg(
        F.count(F.lit(1)).alias("unique_ips"),
        F.count_if(F.col("request_count") == 1).alias("bounced_ips"),
    )
    return counted.withColumn(
        "bounce_rate", percentage(F.col("bounced_ips"), F.col("unique_ips"))
    )


# The shop's steps, from the home page to the checkout.
FUNNEL_STEPS = ("/home", "/products", "/product/*", "/cart", "/checkout")


def on_step(step: str) -> Column:
    """Whether a request is for ``step``; a final ``*`` stands for any rest."""
    endpoint = F.col("endpoint")
    return endpoint.startswith(step[:-1]) if step.endswith("*") else endpoint == step


def funnel(logs: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """(Step, Unique_IPs): addresses that reached each step, in any order.

    One pass for all steps: an address becomes one row with a flag per step.
    Distinct counts side by side would copy every request once per step.
    """
    flags = [f"step_{i}" for i in range(len(steps))]
    reached = logs.groupBy("ip").agg(
        *[F.bool_or(on_step(step)).alias(flag) for step, flag in zip(steps, flags)]
    )
    known = F.col("ip").isNotNull()
    counted = reached.agg(*[F.count_if(known & F.col(flag)).alias(flag) for flag in flags])
    return metric_rows(
        counted, dict(zip(steps, map(F.col, flags))), label="Step", value="Unique_IPs"
    )


def abusive_ips(logs: DataFrame, window: str = "1 minute", threshold: int = 50) -> DataFrame:
    """Addresses with more than ``threshold`` requests in one tumbling window, at least one.

    ``window_start`` is the instant at which the window begins, ``minute_start`` its clock time.
    Requests without a time are in no window. They are kept from counting
    instead of filtered out, as a filter on raw lines would parse each time twice.
    """
    time = F.col("parsed_timestamp")
    some_time = F.coalesce(time, F.lit(0).cast(TimestampType()))
    return (
        logs.groupBy("ip", F.window(some_time, window).alias("span"))
        .agg(F.count(time).alias("requests_per_min"))
        .where((F.col("requests_per_min") > 0) & (F.col("requests_per_min") > threshold))
        .orderBy(F.desc("requests_per_min"), "ip", "span.start")
        .select(
            "ip",
            "requests_per_min",
            F.col("span.start").alias("window_start"),
            F.date_format("span.start", "HH:mm:ss").alias("minute_start"),
        )
    )


def high_404_ips(logs: DataFrame | AddressTotals, min_requests: int = 10, rate: float = 50) -> DataFrame:
    """Addresses whose share of 404 answers, rounded, is above ``rate`` percent."""
    rated = (
        ip_totals(logs)
        .table.withColumnRenamed("request_count", "total_requests")
        .withColumn("rate_404", percentage(F.col("requests_404"), F.col("total_requests")))
    )
    return rated.where(
        (F.col("total_requests") > min_requests) & (F.col("rate_404") > rate)
    ).orderBy(F.desc("rate_404"), "ip")
