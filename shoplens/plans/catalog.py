"""Every analysis bound to the driver's tables, under the name it is checked by.

The parameters are the ones at which the driver's tables give rows; the
operators' own defaults suit the shop's real data.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators import (
    customers as customer_ops,
    orders as order_ops,
    people as people_ops,
    profile,
    reports,
    shop,
    traffic,
    visitors,
    weblogs,
)
from shoplens.sources import bindings, column_types

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """The bound tables of one directory; each is built when asked for."""

    def __init__(self, spark: SparkSession, directory: str):
        self._at = (spark, directory)

    @property
    def customers(self) -> DataFrame:
        return bindings.bind_customers(*self._at)

    @property
    def located_customers(self) -> DataFrame:
        return bindings.bind_customers_with_country(*self._at)

    @property
    def orders(self) -> DataFrame:
        return bindings.bind_orders(*self._at)

    @property
    def products(self) -> DataFrame:
        return bindings.bind_products(*self._at)

    @property
    def people(self) -> DataFrame:
        return bindings.bind_people(*self._at)

    @property
    def lines(self) -> DataFrame:
        return bindings.bind_web_lines(*self._at)

    @property
    def logs(self) -> DataFrame:
        return weblogs.parse_weblogs(self.lines)


def _published(result: DataFrame) -> DataFrame:
    """Whole numbers as bigint, dates as ISO text, instants as UTC wall time."""
    casts = {"int": "bigint", "date": "string", "timestamp": "timestamp_ntz"}
    return result.select(
        *[
            F.col(name).cast(casts[kind]).alias(name) if kind in casts else F.col(name)
            for name, kind in result.dtypes
        ]
    )


_SLOW = {"min_hits": 10, "min_avg_ms": 490}

ANALYSES: dict[str, Callable[[Tables], DataFrame]] = {
    # profile
    "row_counts": lambda t: profile.row_counts(
        {"customers": t.customers, "products": t.products, "orders": t.orders}
    ),
    "null_counts_customers": lambda t: profile.null_counts(t.located_customers),
    "null_counts_orders": lambda t: profile.null_counts(t.orders),
    "duplicate_keys_customers": lambda t: profile.duplicate_keys(t.customers, "customerNumber"),
    "duplicate_order_numbers": lambda t: profile.duplicate_keys(t.orders, "orderNumber"),
    "duplicate_keys_orders": lambda t: profile.duplicate_keys(t.orders, "customerNumber"),
    "distinct_status": lambda t: profile.distinct_values(t.orders, "status"),
    "distinct_payment": lambda t: profile.distinct_values(t.orders, "paymentMethod"),
    "column_types_orders": lambda t: column_types(t.orders),
    "column_types_logs": lambda t: column_types(t.logs.drop("timestamp")),
    # shop
    "customers_by_segment": lambda t: shop.customers_by_segment(t.customers),
    "top_countries": lambda t: shop.top_countries(t.located_customers),
    "orders_by_status": lambda t: shop.orders_by_status(t.orders),
    "orders_by_payment": lambda t: shop.orders_by_payment(t.orders),
    "products_by_category": lambda t: shop.products_by_category(t.products),
    "order_amount_stats": lambda t: shop.order_amount_stats(t.orders),
    "credit_by_segment": lambda t: shop.credit_by_segment(t.customers),
    "product_price_stats": lambda t: shop.product_price_stats(t.products),
    "top_credit_country": lambda t: shop.top_credit_country(t.located_customers),
    "top_order_status": lambda t: shop.top_order_status(t.orders),
    "top_stock_category": lambda t: shop.top_stock_category(t.products),
    "segment_share": lambda t: shop.segment_share(t.customers, "BUILDING"),
    "ecommerce_summary": lambda t: reports.ecommerce_summary(t.customers, t.products, t.orders),
    # customers and people
    "enterprise_upper": lambda t: customer_ops.segment_customers(
        t.located_customers, "BUILDING", columns=("customerName", "country")
    ),
    "customers_in_country": lambda t: customer_ops.customers_in_country(
        t.located_customers, "NATION_1"
    ).select("customerNumber", "customerName", "country"),
    "people_over_30": lambda t: people_ops.people_over(t.people, 30),
    "people_avg_salary": lambda t: people_ops.average_salary_by_city(t.people).withColumn(
        "avg_salary", F.round("avg_salary", 6)
    ),
    # orders
    "orders_by_month": lambda t: order_ops.orders_by_month(t.orders),
    "high_value_orders": lambda t: order_ops.high_value_orders(t.orders, 250000).select(
        "orderNumber", "totalAmount"
    ),
    "order_projection": lambda t: order_ops.order_projection(t.orders),
    "order_size_distribution": lambda t: order_ops.order_size_distribution(
        t.orders, (100000, 300000)
    ),
    "shipped_pipeline": lambda t: order_ops.shipped_orders(t.orders, (150000, 300000)),
    "orders_reduced": lambda t: order_ops.orders_reduced(t.orders),
    "orders_from_date": lambda t: order_ops.orders_from_date(
        t.orders, datetime.date(1999, 6, 1)
    ).select("orderNumber", "orderDate"),
    "large_order_flag": lambda t: order_ops.large_order_flag(t.orders, 200000).select(
        "orderNumber", "totalAmount", "isLargeOrder"
    ),
    "orders_in_status_list": lambda t: order_ops.orders_in_status_list(t.orders).select(
        "orderNumber", "status"
    ),
    "order_code": lambda t: order_ops.order_code(t.orders).select("orderNumber", "orderCode"),
    "top_orders": lambda t: order_ops.top_orders(t.orders).select("orderNumber", "totalAmount"),
    # web logs
    "weblog_parse": lambda t: t.logs.drop("timestamp"),
    "weblog_quality": lambda t: weblogs.weblog_quality(t.lines),
    "status_distribution": lambda t: traffic.status_distribution(t.logs),
    "method_distribution": lambda t: traffic.method_distribution(t.logs),
    "top_endpoints": lambda t: traffic.top_endpoints(t.logs),
    "error_counts": lambda t: traffic.error_counts(t.logs),
    "top_404_pages": lambda t: traffic.top_404_pages(t.logs),
    "pages_5xx": lambda t: traffic.pages_5xx(t.logs),
    "latency_summary": lambda t: traffic.latency_summary(t.logs),
    "slowest_endpoints": lambda t: traffic.slowest_endpoints(t.logs),
    "slowest_requests": lambda t: traffic.slowest_requests(t.logs).select(
        "ip", "endpoint", "parsed_timestamp", "response_time_ms"
    ),
    "traffic_by_hour": lambda t: traffic.traffic_by_hour(t.logs),
    "traffic_share_by_hour": lambda t: traffic.traffic_share(t.logs),
    "peak_hour": lambda t: traffic.peak_hour(t.logs),
    "slow_endpoints": lambda t: traffic.slow_endpoints(t.logs, **_SLOW),
    "slow_endpoint_status_latency": lambda t: traffic.slow_endpoint_status_latency(
        t.logs, **_SLOW
    ),
    "latency_by_hour": lambda t: traffic.latency_by_hour(t.logs),
    "log_summary": lambda t: reports.log_summary(t.logs),
    # visitors
    "top_ips": lambda t: visitors.top_ips(t.logs),
    "requests_per_ip_stats": lambda t: visitors.requests_per_ip_stats(t.logs),
    "bot_ips": lambda t: visitors.bot_ips(t.logs, 70),
    "bounce_rate": lambda t: visitors.bounce_rate(t.logs),
    "bounce_rate_by_day": lambda t: visitors.bounce_rate(
        t.logs, per=F.to_date("parsed_timestamp")
    ).withColumnRenamed("period", "day"),
    "funnel": lambda t: visitors.funnel(t.logs),
    "abusive_ips_per_minute": lambda t: visitors.abusive_ips(t.logs, threshold=1),
    "high_404_ips": lambda t: visitors.high_404_ips(t.logs, rate=7),
}


def _query(analysis: Callable[[Tables], DataFrame]) -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        # Log times carry an offset; hours and minutes are reported in UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _published(analysis(Tables(spark, directory)))

    return run


def queries() -> dict[str, Query]:
    """All queries by name. Building one sets the session's time zone to UTC, for good."""
    return {name: _query(analysis) for name, analysis in ANALYSES.items()}
