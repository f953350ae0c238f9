"""The shop tables, log lines and people, as projections of the driver's tables.

Each function reads one directory of Parquet tables. The file schemas are
stated so that building a query starts no job to look at footers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
}


def read_driver_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{directory}/{name}.parquet")


def _customers_with_nation(spark: SparkSession, directory: str) -> DataFrame:
    # No broadcast hint: Spark broadcasts nation if its size allows it. A customer whose nation
    # is missing stays.
    customer = read_driver_table(spark, directory, "customer")
    nation = read_driver_table(spark, directory, "nation")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left")


def _customer_columns() -> dict[str, Column]:
    key = F.col("c_custkey")
    return {
        "customerNumber": key + 10000,
        "customerName": F.col("c_name"),
        "state": F.when(key % 10 != 0, F.concat(F.lit("S"), key % 50)),
        "country": F.col("n_name"),
        "creditLimit": F.col("c_acctbal"),
        "customerSegment": F.col("c_mktsegment"),
    }


def bind_customers(spark: SparkSession, directory: str) -> DataFrame:
    """Customers without their country, so without a join."""
    columns = _customer_columns()
    del columns["country"]
    return read_driver_table(spark, directory, "customer").select(
        *[column.alias(name) for name, column in columns.items()]
    )


def bind_customers_with_country(spark: SparkSession, directory: str) -> DataFrame:
    """All customers; the country is null where there is no such nation."""
    return _customers_with_nation(spark, directory).select(
        *[column.alias(name) for name, column in _customer_columns().items()]
    )


def bind_people(spark: SparkSession, directory: str) -> DataFrame:
    return _customers_with_nation(spark, directory).select(
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 60 + 18).alias("age"),
        F.col("n_name").alias("city"),
        F.col("c_acctbal").alias("salary"),
    )


def bind_orders(spark: SparkSession, directory: str) -> DataFrame:
    key = F.col("o_orderkey")
    ordered = F.col("o_orderdate").cast("date")
    status = F.col("o_orderstatus")
    return read_driver_table(spark, directory, "orders").select(
        (key + 200000).alias("orderNumber"),
        ordered.alias("orderDate"),
        F.date_add(ordered, (key % 9 + 2).cast("int")).alias("requiredDate"),
        F.when(status == "F", "Delivered")
        .when(status == "O", "In Process")
        .otherwise("Shipped")
        .alias("status"),
        (F.col("o_custkey") + 10000).alias("customerNumber"),
        F.col("o_totalprice").alias("totalAmount"),
        F.when(key % 50 != 0, F.col("o_orderpriority")).alias("paymentMethod"),
    )


def bind_products(spark: SparkSession, directory: str) -> DataFrame:
    return read_driver_table(spark, directory, "part").select(
        F.concat(F.lit("P_"), F.col("p_partkey") + 100).alias("productCode"),
        F.col("p_name").alias("productName"),
        F.col("p_type").alias("productCategory"),
        F.col("p_size").alias("quantityInStock"),
        F.col("p_retailprice").alias("buyPrice"),
        (F.col("p_retailprice") + F.col("p_size")).alias("MSRP"),
    )


def _method(event_id: Column) -> Column:
    position = event_id % 4
    return (
        F.when(position == 0, "GET")
        .when(position == 1, "POST")
        .when(position == 2, "PUT")
        .otherwise("DELETE")
    )


def _endpoint(event_id: Column, event_type: Column, user_id: Column) -> Column:
    return (
        F.when(event_type == "signup", "/home")
        .when(event_type == "view", "/products")
        .when((event_type == "click") & (event_id % 2 == 0), "/cart")
        .when(event_type == "click", F.concat(F.lit("/product/"), user_id % 10))
        .when(event_type == "purchase", "/checkout")
        .otherwise("/error_page")
    )


def _status(event_id: Column, event_type: Column) -> Column:
    failed = event_type == "error"
    return (
        F.when(failed & (event_id % 3 == 0), "404")
        .when(failed & (event_id % 3 == 1), "500")
        .when(failed, "503")
        .when(event_id % 7 == 0, "304")
        .otherwise("200")
    )


def bind_web_lines(spark: SparkSession, directory: str) -> DataFrame:
    """One raw access-log line per event; every fiftieth does not parse.

    The line leaves through ``explode``, past which Spark moves no filter. A
    filter below the projection would build the whole line again per predicate,
    where a text source has it at hand.
    """
    event_id, user_id, event_type = F.col("event_id"), F.col("user_id"), F.col("event_type")
    line = F.concat(
        F.lit("192.168.1."),
        user_id,
        F.lit(" ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' +0000] "'),
        _method(event_id),
        F.lit(" "),
        _endpoint(event_id, event_type, user_id),
        F.lit(' HTTP/1.1" '),
        _status(event_id, event_type),
        F.lit(" "),
        F.floor(F.col("value") * 10).cast("int"),
    )
    damaged = F.concat(F.lit("corrupt line "), event_id)
    return read_driver_table(spark, directory, "events").select(
        F.explode(F.array(F.when(event_id % 50 == 0, damaged).otherwise(line))).alias("value")
    )
