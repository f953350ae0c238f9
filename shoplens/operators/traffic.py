"""Distributions, errors, latency and hourly traffic of parsed requests.

Each analysis but ``slowest_requests`` takes requests or totals of them, as ``totals`` gives,
and finds the same: a request is a total of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import percentage
from shoplens.operators.kept import Totals


class RequestTotals(Totals):
    """Requests added up over some keys, as ``totals`` gives them."""


Requests = DataFrame | RequestTotals


def _as_totals(logs: Requests) -> DataFrame:
    """A table of totals; what kind of table it is, its type says, not its columns."""
    if isinstance(logs, RequestTotals):
        return logs.table
    latency = F.col("response_time_ms")
    return logs.withColumns(
        {
            "hour": F.hour("parsed_timestamp").cast("bigint"),
            "requests": F.lit(1).cast("bigint"),
            "timed": F.when(latency.isNull(), 0).otherwise(1).cast("bigint"),
            "total_ms": latency.cast("bigint"),
            "min_ms": latency.cast("bigint"),
            "max_ms": latency.cast("bigint"),
        }
    )


def totals(logs: Requests, *keys: str) -> RequestTotals:
    """Number, sum and extremes of latency per combination of ``keys``.

    ``keys`` are columns of requests, or ``hour``. Worth persisting where several analyses need
    no other column. Latencies are whole milliseconds, so sums and averages stay exact.
    """
    return RequestTotals(
        _as_totals(logs)
        .groupBy(*keys)
        .agg(
            _requests().alias("requests"),
            F.sum("timed").alias("timed"),
            F.sum("total_ms").alias("total_ms"),
            F.min("min_ms").alias("min_ms"),
            F.max("max_ms").alias("max_ms"),
        )
    )


def hour_totals(logs: Requests) -> RequestTotals:
    """Totals per hour of the day, status and method."""
    return totals(logs, "hour", "status", "method")


def page_totals(logs: Requests) -> RequestTotals:
    """Totals per endpoint and status."""
    return totals(logs, "endpoint", "status")


def _requests(condition: Column | None = None) -> Column:
    """The number of requests (for which the condition holds), 0 for none."""
    counted = F.col("requests") if condition is None else F.when(condition, F.col("requests"))
    return F.coalesce(F.sum(counted), F.lit(0)).cast("bigint")


def _average() -> Column:
    return F.try_divide(F.sum("total_ms"), F.sum("timed"))


def _distribution(logs: Requests, *keys: str, top: int | None = None) -> DataFrame:
    """Requests per combination of ``keys``, most frequent first, ties by key."""
    counted = _as_totals(logs).groupBy(*keys).agg(_requests().alias("count"))
    ordered = counted.orderBy(F.desc("count"), *keys)
    return ordered if top is None else ordered.limit(top)


def status_distribution(logs: Requests) -> DataFrame:
    return _distribution(logs, "status")


def method_distribution(logs: Requests) -> DataFrame:
    return _distribution(logs, "method")


def _by_endpoint(logs: Requests, count: str) -> DataFrame:
    """(endpoint, count, avg_latency_ms) with averages not rounded."""
    return _as_totals(logs).groupBy("endpoint").agg(
        _requests().alias(count), _average().alias("avg_latency_ms")
    )


def top_endpoints(logs: Requests, k: int = 10) -> DataFrame:
    return _distribution(logs, "endpoint", top=k)


# ---- errors -----------------------------------------------------------------


def is_client_error() -> Column:
    return (F.col("status") >= 400) & (F.col("status") < 500)


def is_server_error() -> Column:
    """5xx and, as nothing bounds it, any larger status."""
    return F.col("status") >= 500


def error_counts(logs: Requests) -> DataFrame:
    """One row; ``total_errors`` ends below 600, ``errors_5xx`` does not."""
    status = F.col("status")
    return _as_totals(logs).agg(
        _requests((status >= 400) & (status < 600)).alias("total_errors"),
        _requests(is_client_error()).alias("errors_4xx"),
        _requests(is_server_error()).alias("errors_5xx"),
    )


def top_404_pages(logs: Requests, k: int = 10) -> DataFrame:
    return _distribution(logs.where(F.col("status") == 404), "endpoint", top=k)


def pages_5xx(logs: Requests, k: int | None = None) -> DataFrame:
    """All pages that answered with a server error, or the ``k`` with the most."""
    return _distribution(logs.where(is_server_error()), "endpoint", "status", top=k)


# ---- latency ----------------------------------------------------------------


def latency_summary(logs: Requests) -> DataFrame:
    return _as_totals(logs).agg(
        F.coalesce(F.sum("timed"), F.lit(0)).alias("count"),
        F.min("min_ms").alias("min"),
        F.max("max_ms").alias("max"),
        F.round(_average(), 2).alias("mean"),
    )


def _rounded_latency(table: DataFrame) -> DataFrame:
    return table.withColumn("avg_latency_ms", F.round("avg_latency_ms", 2))


def slowest_endpoints(logs: Requests, min_requests: int = 10, k: int = 10) -> DataFrame:
    """The ``k`` endpoints slowest on average, of those with more than ``min_requests``."""
    slowest = (
        _by_endpoint(logs, "request_count")
        .where(F.col("request_count") > min_requests)
        .orderBy(F.desc("avg_latency_ms"), "endpoint")
        .limit(k)
    )
    return _rounded_latency(slowest)


def slowest_requests(logs: DataFrame, k: int = 10) -> DataFrame:
    return logs.orderBy(
        F.desc("response_time_ms"), "parsed_timestamp", "ip", "endpoint", "method", "status"
    ).limit(k)


def slow_endpoints(logs: Requests, min_hits: int = 10, min_avg_ms: float = 2000) -> DataFrame:
    """Endpoints with more than ``min_hits`` and an unrounded average above the cut."""
    slow = _by_endpoint(logs, "hit_count").where(
        (F.col("hit_count") > min_hits) & (F.col("avg_latency_ms") > min_avg_ms)
    )
    return _rounded_latency(slow.orderBy(F.desc("avg_latency_ms"), "endpoint"))


def slow_endpoint_status_latency(
    logs: Requests, min_hits: int = 10, min_avg_ms: float = 2000
) -> DataFrame:
    """Average latency per status of the endpoints ``slow_endpoints`` finds.

    The requests are read once: they are added up per endpoint and status, and
    the endpoint totals that decide come from those sums.
    """
    by_status = page_totals(logs).table
    endpoint = Window.partitionBy("endpoint")
    rated = by_status.select(
        "endpoint",
        "status",
        F.try_divide("total_ms", "timed").alias("avg_latency_ms"),
        F.sum("requests").over(endpoint).alias("endpoint_hits"),
        F.try_divide(F.sum("total_ms").over(endpoint), F.sum("timed").over(endpoint)).alias(
            "endpoint_avg_ms"
        ),
    )
    slow = rated.where(
        F.col("endpoint").isNotNull()
        & (F.col("endpoint_hits") > min_hits)
        & (F.col("endpoint_avg_ms") > min_avg_ms)
    )
    ordered = slow.orderBy(F.desc("avg_latency_ms"), "endpoint", "status")
    return _rounded_latency(ordered.select("endpoint", "status", "avg_latency_ms"))


# ---- hours ------------------------------------------------------------------


def traffic_by_hour(logs: Requests) -> DataFrame:
    """Requests per hour of the day; lines with an impossible time form a null hour."""
    return _hourly(logs).orderBy("hour")


def _hourly(logs: Requests) -> DataFrame:
    return _as_totals(logs).groupBy("hour").agg(_requests().alias("count"))


def _hourly_share(logs: Requests) -> DataFrame:
    # The window holds the 24 hours and null, 25 rows however many requests.
    total = F.sum("count").over(Window.partitionBy())
    return _hourly(logs).withColumn("percentage", percentage(F.col("count"), total))


def traffic_share(logs: Requests) -> DataFrame:
    """Requests per hour and their share of all requests."""
    return _hourly_share(logs).orderBy("hour")


def peak_hour(logs: Requests) -> DataFrame:
    """The busiest hour, the earliest one on a tie; no row for no requests."""
    return _hourly_share(logs).orderBy(F.desc("count"), "hour").limit(1)


def latency_by_hour(logs: Requests) -> DataFrame:
    hourly = _as_totals(logs).groupBy("hour").agg(
        _average().alias("avg_latency_ms"), _requests().alias("total_requests")
    )
    return _rounded_latency(hourly.orderBy(F.desc("avg_latency_ms"), "hour"))
