"""The SQL each registered query is checked against, for DuckDB.

One statement per query over the driver's tables: the bound tables come first,
as common table expressions.
"""

from __future__ import annotations

_VIEWS = {
    "ec_customers": r"""
SELECT 10000 + c_custkey AS "customerNumber", c_name AS "customerName",
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'S' || CAST(c_custkey % 50 AS VARCHAR) END AS state,
       n_name AS country, c_acctbal AS "creditLimit", c_mktsegment AS "customerSegment"
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
    "ec_orders": r"""
SELECT 200000 + o_orderkey AS "orderNumber",
       strftime(o_orderdate, '%Y-%m-%d') AS "orderDate",
       strftime(o_orderdate + to_days(CAST(2 + o_orderkey % 9 AS INTEGER)), '%Y-%m-%d') AS "requiredDate",
       CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'In Process' ELSE 'Shipped' END AS status,
       10000 + o_custkey AS "customerNumber", o_totalprice AS "totalAmount",
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderpriority END AS "paymentMethod"
FROM orders
""",
    "ec_products": r"""
SELECT 'P_' || CAST(100 + p_partkey AS VARCHAR) AS "productCode", p_name AS "productName",
       p_type AS "productCategory", p_size AS "quantityInStock",
       p_retailprice AS "buyPrice", p_retailprice + p_size AS "MSRP"
FROM part
""",
    "web_raw": r"""
SELECT CASE WHEN event_id % 50 = 0 THEN 'corrupt line ' || CAST(event_id AS VARCHAR) ELSE
  '192.168.1.' || CAST(user_id AS VARCHAR) || ' [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "' ||
  CASE event_id % 4 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' WHEN 2 THEN 'PUT' ELSE 'DELETE' END || ' ' ||
  CASE WHEN event_type = 'signup' THEN '/home' WHEN event_type = 'view' THEN '/products'
       WHEN event_type = 'click' AND event_id % 2 = 0 THEN '/cart'
       WHEN event_type = 'click' THEN '/product/' || CAST(user_id % 10 AS VARCHAR)
       WHEN event_type = 'purchase' THEN '/checkout' ELSE '/error_page' END || ' HTTP/1.1" ' ||
  CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN '404'
       WHEN event_type = 'error' AND event_id % 3 = 1 THEN '500' WHEN event_type = 'error' THEN '503'
       WHEN event_id % 7 = 0 THEN '304' ELSE '200' END || ' ' ||
  CAST(CAST(floor(value * 10) AS INTEGER) AS VARCHAR) END AS value
FROM events
""",
    "web_logs": r"""
SELECT ip, method, endpoint, CAST(st AS INTEGER) AS status, CAST(ms AS INTEGER) AS response_time_ms,
       strptime(left(tsx, 20), '%d/%b/%Y:%H:%M:%S') AS parsed_timestamp
FROM (SELECT regexp_extract(value, p, 1) AS ip, regexp_extract(value, p, 2) AS tsx,
             regexp_extract(value, p, 3) AS method, regexp_extract(value, p, 4) AS endpoint,
             regexp_extract(value, p, 6) AS st, regexp_extract(value, p, 7) AS ms
      FROM (SELECT value, '^(\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+) (\S+)" (\d+) (\d+)$' AS p FROM web_raw))
WHERE ip <> ''
""",
    "people": r"""
SELECT c_name AS name, 18 + c_custkey % 60 AS age, n_name AS city, c_acctbal AS salary
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
}

_KIND = r"""CASE WHEN v IS NULL OR v = '' THEN 0
  WHEN regexp_full_match(v, '[+-]?[0-9]{1,40}') THEN CASE
    WHEN TRY_CAST(v AS INTEGER) IS NOT NULL THEN 1 WHEN TRY_CAST(v AS BIGINT) IS NOT NULL THEN 2 ELSE 4 END
  WHEN regexp_full_match(v, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
    OR v IN ('NaN', 'Infinity', '-Infinity') THEN 4
  WHEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(v AS DATE) IS NOT NULL THEN 8
  WHEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?')
    AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL THEN 16
  WHEN lower(v) IN ('true', 'false') THEN 32 ELSE 64 END"""


def _types(view: str, columns: list[str]) -> str:
    """The types that the text of some columns allows, a column at a time."""
    each = [
        f"""SELECT {at} AS position, '{name}' AS "column", coalesce(bit_or(k), 0) AS k,
  count(*) FILTER (k <> 0) AS n_values
FROM (SELECT {_KIND} AS k FROM (SELECT CAST("{name}" AS VARCHAR) AS v FROM {view}))"""
        for at, name in enumerate(columns)
    ]
    return f"""
SELECT position, "column", n_values, CASE WHEN k = 0 THEN 'string' WHEN k = 1 THEN 'int'
  WHEN k IN (2, 3) THEN 'bigint' WHEN k < 8 THEN 'double' WHEN k = 8 THEN 'date'
  WHEN k IN (16, 24) THEN 'timestamp' WHEN k = 32 THEN 'boolean' ELSE 'string' END AS type
FROM ({" UNION ALL ".join(each)})
"""


_QUERIES = {
    "column_types_orders": _types(
        "ec_orders",
        [
            "orderNumber",
            "orderDate",
            "requiredDate",
            "status",
            "customerNumber",
            "totalAmount",
            "paymentMethod",
        ],
    ),
    "column_types_logs": _types(
        "web_logs",
        ["ip", "method", "endpoint", "status", "response_time_ms", "parsed_timestamp"],
    ),
    "row_counts": r"""
SELECT 'customers' AS table_name, count(*) AS row_count FROM ec_customers
UNION ALL SELECT 'products', count(*) FROM ec_products
UNION ALL SELECT 'orders', count(*) FROM ec_orders
""",
    "null_counts_customers": r"""
SELECT count(*) - count("customerNumber") AS "customerNumber", count(*) - count("customerName") AS "customerName",
       count(*) - count(state) AS state, count(*) - count(country) AS country,
       count(*) - count("creditLimit") AS "creditLimit", count(*) - count("customerSegment") AS "customerSegment"
FROM ec_customers
""",
    "null_counts_orders": r"""
SELECT count(*) - count("orderNumber") AS "orderNumber", count(*) - count("orderDate") AS "orderDate",
       count(*) - count("requiredDate") AS "requiredDate", count(*) - count(status) AS status,
       count(*) - count("customerNumber") AS "customerNumber", count(*) - count("totalAmount") AS "totalAmount",
       count(*) - count("paymentMethod") AS "paymentMethod"
FROM ec_orders
""",
    "duplicate_keys_orders": r"""
SELECT count(*) AS total, count(DISTINCT "customerNumber") AS distinct_ids,
       count(*) - count(DISTINCT "customerNumber") AS duplicates FROM ec_orders
""",
    "duplicate_keys_customers": r"""
SELECT count(*) AS total, count(DISTINCT "customerNumber") AS distinct_ids,
       count(*) - count(DISTINCT "customerNumber") AS duplicates FROM ec_customers
""",
    "duplicate_order_numbers": r"""
SELECT count(*) AS total, count(DISTINCT "orderNumber") AS distinct_ids,
       count(*) - count(DISTINCT "orderNumber") AS duplicates FROM ec_orders
""",
    "customers_by_segment": r"""
SELECT "customerSegment", count(*) AS "count" FROM ec_customers GROUP BY 1
""",
    "top_countries": r"""
SELECT country, count(*) AS "count" FROM ec_customers GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""",
    "orders_by_status": r"""
SELECT status, count(*) AS "count" FROM ec_orders GROUP BY 1
""",
    "orders_by_payment": r"""
SELECT "paymentMethod", count(*) AS "count" FROM ec_orders GROUP BY 1
""",
    "products_by_category": r"""
SELECT "productCategory", count(*) AS "count" FROM ec_products GROUP BY 1
""",
    "order_amount_stats": r"""
SELECT count("totalAmount") AS "Count", round(sum("totalAmount"), 2) AS "Total_Sum", round(min("totalAmount"), 2) AS "Minimum",
       round(max("totalAmount"), 2) AS "Maximum", round(avg("totalAmount"), 2) AS "Average" FROM ec_orders
""",
    "credit_by_segment": r"""
SELECT "customerSegment", count("creditLimit") AS "Count", round(avg("creditLimit"), 2) AS "Average_Credit",
       round(max("creditLimit"), 2) AS "Max_Credit" FROM ec_customers GROUP BY 1
""",
    "product_price_stats": r"""
SELECT min("buyPrice") AS min_buy, max("buyPrice") AS max_buy, round(avg("buyPrice"), 2) AS avg_buy,
       min("MSRP") AS min_msrp, max("MSRP") AS max_msrp, round(avg("MSRP"), 2) AS avg_msrp FROM ec_products
""",
    "top_credit_country": r"""
SELECT country, round(sum("creditLimit"), 2) AS total_credit FROM ec_customers GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1
""",
    "top_order_status": r"""
SELECT status, count(*) AS "count" FROM ec_orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1
""",
    "top_stock_category": r"""
SELECT "productCategory", CAST(sum("quantityInStock") AS BIGINT) AS total_stock FROM ec_products GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1
""",
    "segment_share": r"""
SELECT count(*) FILTER (WHERE "customerSegment" = 'BUILDING') AS segment_count, count(*) AS total,
       round(100.0 * count(*) FILTER (WHERE "customerSegment" = 'BUILDING') / count(*), 2) AS pct FROM ec_customers
""",
    "orders_by_month": r"""
SELECT CAST(month(CAST("orderDate" AS DATE)) AS BIGINT) AS "Month", count(*) AS "count" FROM ec_orders GROUP BY 1
""",
    "ecommerce_summary": r"""
SELECT 'Total Customers' AS "Metric", CAST(count(*) AS VARCHAR) AS "Value" FROM ec_customers
UNION ALL SELECT 'Total Products', CAST(count(*) AS VARCHAR) FROM ec_products
UNION ALL SELECT 'Total Orders', CAST(count(*) AS VARCHAR) FROM ec_orders
UNION ALL SELECT 'Total Revenue', printf('%.2f', sum("totalAmount")) FROM ec_orders
UNION ALL SELECT 'Average Order Value', printf('%.2f', avg("totalAmount")) FROM ec_orders
""",
    "enterprise_upper": r"""
SELECT "customerName", country, upper("customerName") AS "customerNameUpper" FROM ec_customers WHERE "customerSegment" = 'BUILDING'
""",
    "customers_in_country": r"""
SELECT "customerNumber", "customerName", country FROM ec_customers WHERE country = 'NATION_1'
""",
    "high_value_orders": r"""
SELECT "orderNumber", "totalAmount" FROM ec_orders WHERE "totalAmount" > 250000
""",
    "order_projection": r"""
SELECT "orderNumber" AS id, "orderDate" AS date, "totalAmount" AS amount, status FROM ec_orders
""",
    "order_size_distribution": r"""
SELECT CASE WHEN "totalAmount" < 100000 THEN 'Small' WHEN "totalAmount" >= 100000 AND "totalAmount" < 300000 THEN 'Medium' ELSE 'Large' END AS "orderSize",
       count(*) AS "count" FROM ec_orders GROUP BY 1
""",
    "shipped_pipeline": r"""
SELECT "orderNumber", "orderDate", round("totalAmount", 0) AS "amountRounded",
       CASE WHEN "totalAmount" > 300000 THEN 'High' WHEN "totalAmount" > 150000 THEN 'Medium' ELSE 'Low' END AS priority, status
FROM ec_orders WHERE status = 'Shipped'
""",
    "orders_reduced": r"""
SELECT "orderNumber", "orderDate", status, "customerNumber", "totalAmount" FROM ec_orders
""",
    "distinct_status": r"""
SELECT DISTINCT status FROM ec_orders
""",
    "distinct_payment": r"""
SELECT DISTINCT "paymentMethod" FROM ec_orders
""",
    "orders_from_date": r"""
SELECT "orderNumber", "orderDate" FROM ec_orders WHERE CAST("orderDate" AS DATE) >= DATE '1999-06-01'
""",
    "large_order_flag": r"""
SELECT "orderNumber", "totalAmount", "totalAmount" > 200000 AS "isLargeOrder" FROM ec_orders
""",
    "orders_in_status_list": r"""
SELECT "orderNumber", status FROM ec_orders WHERE status IN ('Processing', 'Shipped')
""",
    "order_code": r"""
SELECT "orderNumber", 'ORDER-' || repeat('0', greatest(0, 5 - length(CAST("orderNumber" AS VARCHAR)))) || "orderNumber" AS "orderCode" FROM ec_orders
""",
    "top_orders": r"""
SELECT "orderNumber", "totalAmount" FROM ec_orders ORDER BY "totalAmount" DESC, "orderNumber" LIMIT 10
""",
    "weblog_parse": r"""
SELECT ip, method, endpoint, CAST(status AS BIGINT) AS status, CAST(response_time_ms AS BIGINT) AS response_time_ms, parsed_timestamp FROM web_logs
""",
    "weblog_quality": r"""
SELECT (SELECT count(*) FROM web_raw) AS total, (SELECT count(*) FROM web_logs) AS valid,
       (SELECT count(*) FROM web_raw) - (SELECT count(*) FROM web_logs) AS invalid
""",
    "status_distribution": r"""
SELECT CAST(status AS BIGINT) AS status, count(*) AS "count" FROM web_logs GROUP BY 1
""",
    "method_distribution": r"""
SELECT method, count(*) AS "count" FROM web_logs GROUP BY 1
""",
    "top_endpoints": r"""
SELECT endpoint, count(*) AS "count" FROM web_logs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""",
    "error_counts": r"""
SELECT count(*) FILTER (WHERE status >= 400 AND status < 600) AS total_errors,
       count(*) FILTER (WHERE status >= 400 AND status < 500) AS errors_4xx,
       count(*) FILTER (WHERE status >= 500) AS errors_5xx FROM web_logs
""",
    "top_404_pages": r"""
SELECT endpoint, count(*) AS "count" FROM web_logs WHERE status = 404 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""",
    "pages_5xx": r"""
SELECT endpoint, CAST(status AS BIGINT) AS status, count(*) AS "count" FROM web_logs WHERE status >= 500 GROUP BY 1, 2
""",
    "latency_summary": r"""
SELECT count(response_time_ms) AS "count", CAST(min(response_time_ms) AS BIGINT) AS "min",
       CAST(max(response_time_ms) AS BIGINT) AS "max", round(avg(response_time_ms), 2) AS mean FROM web_logs
""",
    "slowest_endpoints": r"""
SELECT endpoint, count(*) AS request_count, round(avg(response_time_ms), 2) AS avg_latency_ms FROM web_logs
GROUP BY 1 HAVING count(*) > 10 ORDER BY avg(response_time_ms) DESC, 1 LIMIT 10
""",
    "slowest_requests": r"""
SELECT ip, endpoint, parsed_timestamp, CAST(response_time_ms AS BIGINT) AS response_time_ms FROM web_logs
ORDER BY response_time_ms DESC, parsed_timestamp, ip LIMIT 10
""",
    "traffic_by_hour": r"""
SELECT CAST(hour(parsed_timestamp) AS BIGINT) AS hour, count(*) AS "count" FROM web_logs GROUP BY 1
""",
    "top_ips": r"""
SELECT ip, count(*) AS request_count FROM web_logs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""",
    "requests_per_ip_stats": r"""
SELECT count(n) AS "count", round(avg(n), 2) AS mean, round(stddev_samp(n), 2) AS stddev, min(n) AS "min", max(n) AS "max"
FROM (SELECT ip, count(*) AS n FROM web_logs GROUP BY 1)
""",
    "bot_ips": r"""
SELECT ip, count(*) AS request_count FROM web_logs GROUP BY 1 HAVING count(*) > 70
""",
    "log_summary": r"""
SELECT 'Total Requests' AS "Metric", count(*) AS "Value" FROM web_logs
UNION ALL SELECT 'Valid Requests', count(*) FROM web_logs
UNION ALL SELECT 'Unique IPs', count(DISTINCT ip) FROM web_logs
UNION ALL SELECT 'Unique Pages', count(DISTINCT endpoint) FROM web_logs
UNION ALL SELECT '4xx Errors', count(*) FILTER (WHERE status >= 400 AND status < 500) FROM web_logs
UNION ALL SELECT '5xx Errors', count(*) FILTER (WHERE status >= 500) FROM web_logs
""",
    "bounce_rate": r"""
SELECT count(*) AS unique_ips, count(*) FILTER (WHERE n = 1) AS bounced_ips,
       round(100.0 * count(*) FILTER (WHERE n = 1) / count(*), 2) AS bounce_rate
FROM (SELECT ip, count(*) AS n FROM web_logs GROUP BY 1)
""",
    "bounce_rate_by_day": r"""
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS unique_ips, count(*) FILTER (WHERE n = 1) AS bounced_ips,
       round(100.0 * count(*) FILTER (WHERE n = 1) / count(*), 2) AS bounce_rate
FROM (SELECT CAST(parsed_timestamp AS DATE) AS day, ip, count(*) AS n FROM web_logs GROUP BY 1, 2) GROUP BY 1
""",
    "funnel": r"""
SELECT '/home' AS "Step", count(DISTINCT ip) FILTER (WHERE endpoint = '/home') AS "Unique_IPs" FROM web_logs
UNION ALL SELECT '/products', count(DISTINCT ip) FILTER (WHERE endpoint = '/products') FROM web_logs
UNION ALL SELECT '/product/*', count(DISTINCT ip) FILTER (WHERE starts_with(endpoint, '/product/')) FROM web_logs
UNION ALL SELECT '/cart', count(DISTINCT ip) FILTER (WHERE endpoint = '/cart') FROM web_logs
UNION ALL SELECT '/checkout', count(DISTINCT ip) FILTER (WHERE endpoint = '/checkout') FROM web_logs
""",
    "traffic_share_by_hour": r"""
SELECT hour, "count", round(("count" / sum("count") OVER ()) * 100, 2) AS percentage
FROM (SELECT CAST(hour(parsed_timestamp) AS BIGINT) AS hour, count(*) AS "count" FROM web_logs GROUP BY 1)
""",
    "peak_hour": r"""
SELECT hour, "count", round(("count" / sum("count") OVER ()) * 100, 2) AS percentage
FROM (SELECT CAST(hour(parsed_timestamp) AS BIGINT) AS hour, count(*) AS "count" FROM web_logs GROUP BY 1)
ORDER BY "count" DESC, hour LIMIT 1
""",
    "abusive_ips_per_minute": r"""
SELECT ip, count(*) AS requests_per_min, CAST(date_trunc('minute', parsed_timestamp) AS TIMESTAMP) AS window_start,
       strftime(date_trunc('minute', parsed_timestamp), '%H:%M:%S') AS minute_start
FROM web_logs GROUP BY ip, date_trunc('minute', parsed_timestamp) HAVING count(*) > 1
""",
    "high_404_ips": r"""
SELECT ip, count(*) AS total_requests, count(*) FILTER (WHERE status = 404) AS requests_404,
       round((count(*) FILTER (WHERE status = 404) / count(*)) * 100, 2) AS rate_404
FROM web_logs GROUP BY 1 HAVING count(*) > 10 AND round((count(*) FILTER (WHERE status = 404) / count(*)) * 100, 2) > 7
""",
    "slow_endpoints": r"""
SELECT endpoint, count(*) AS hit_count, round(avg(response_time_ms), 2) AS avg_latency_ms FROM web_logs
GROUP BY 1 HAVING count(*) > 10 AND avg(response_time_ms) > 490
""",
    "slow_endpoint_status_latency": r"""
SELECT endpoint, CAST(status AS BIGINT) AS status, round(avg(response_time_ms), 2) AS avg_latency_ms FROM web_logs
WHERE endpoint IN (SELECT endpoint FROM web_logs GROUP BY 1 HAVING count(*) > 10 AND avg(response_time_ms) > 490)
GROUP BY 1, 2
""",
    "latency_by_hour": r"""
SELECT CAST(hour(parsed_timestamp) AS BIGINT) AS hour, round(avg(response_time_ms), 2) AS avg_latency_ms, count(*) AS total_requests
FROM web_logs GROUP BY 1
""",
    "people_avg_salary": r"""
SELECT city, round(avg(salary), 6) AS avg_salary FROM people GROUP BY 1
""",
    "people_over_30": r"""
SELECT name, age, city, salary FROM people WHERE age > 30
""",
}


def _statement(body: str) -> str:
    # web_logs reads web_raw, so a view's own text is searched too.
    used: list[str] = []
    for name in reversed(_VIEWS):
        if any(name in text for text in [body, *(_VIEWS[n] for n in used)]):
            used.append(name)
    views = ", ".join(f"{name} AS ({_VIEWS[name].strip()})" for name in reversed(used))
    return f"WITH {views} {body.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: _statement(body) for name, body in _QUERIES.items()}
