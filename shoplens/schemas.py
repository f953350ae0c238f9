"""Schemas of the tables the analyses work on.

They are given to the readers instead of being inferred: inference reads the
data once more, and it follows a damaged header line. Whole numbers are long, as
the ids of a large table outgrow an int and would read as null.
"""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

CUSTOMERS = StructType(
    [
        StructField("customerNumber", LongType()),
        StructField("customerName", StringType()),
        StructField("contactFirstName", StringType()),
        StructField("contactLastName", StringType()),
        StructField("phone", StringType()),
        StructField("addressLine1", StringType()),
        StructField("city", StringType()),
        StructField("state", StringType()),
        StructField("country", StringType()),
        StructField("creditLimit", DoubleType()),
        StructField("customerSegment", StringType()),
    ]
)

PRODUCTS = StructType(
    [
        StructField("productCode", StringType()),
        StructField("productName", StringType()),
        StructField("productCategory", StringType()),
        StructField("quantityInStock", LongType()),
        StructField("buyPrice", DoubleType()),
        StructField("MSRP", DoubleType()),
    ]
)

ORDERS = StructType(
    [
        StructField("orderNumber", LongType()),
        StructField("orderDate", DateType()),
        StructField("requiredDate", DateType()),
        StructField("status", StringType()),
        StructField("customerNumber", LongType()),
        StructField("totalAmount", DoubleType()),
        StructField("paymentMethod", StringType()),
    ]
)

# Parsed log lines.
REQUESTS = StructType(
    [
        StructField("ip", StringType()),
        StructField("timestamp", StringType()),
        StructField("method", StringType()),
        StructField("endpoint", StringType()),
        StructField("status", IntegerType()),
        StructField("response_time_ms", IntegerType()),
        StructField("parsed_timestamp", TimestampType()),
    ]
)

PEOPLE = StructType(
    [
        StructField("name", StringType()),
        StructField("age", LongType()),
        StructField("city", StringType()),
        StructField("salary", DoubleType()),
    ]
)

# The snake-style column names one loader publishes.
UNDERSCORE_NAMES = {
    "customerNumber": "customer_Number",
    "orderNumber": "order_Number",
    "productCode": "product_Code",
    "buyPrice": "buy_Price",
    "creditLimit": "credit_Limit",
    "totalAmount": "total_Amount",
    "customerSegment": "customer_Segment",
    "paymentMethod": "payment_Method",
    "productCategory": "product_Category",
}
