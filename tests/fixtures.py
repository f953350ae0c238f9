"""Hand-made rows for the operator tests."""

import datetime

from shoplens import schemas

D = datetime.date


def people(spark):
    return spark.createDataFrame(
        [
            ("Alice", 25, "Paris", 3000.0),
            ("Bob", 35, "London", 4500.0),
            ("Charlie", 30, "Paris", 5000.0),
            ("Dina", 40, "Berlin", 6000.0),
        ],
        schemas.PEOPLE,
    )


def orders(spark):
    data = [
        (200000, D(2024, 1, 5), D(2024, 1, 9), "Shipped", 10000, 6000.5, "COD"),
        (200001, D(2024, 1, 6), D(2024, 1, 9), "Shipped", 10001, 2000.0, None),
        (200002, D(2024, 6, 1), D(2024, 6, 9), "Cancelled", 10000, 999.99, "Invoice"),
        (200003, D(2025, 6, 2), D(2025, 6, 9), "Delivered", None, 5000.0, "COD"),
        (200004, D(2024, 5, 31), D(2024, 6, 9), "Shipped", None, 2000.01, None),
        (200005, None, None, "Processing", 10002, None, "COD"),
    ]
    return spark.createDataFrame(data, schemas.ORDERS)


def customers(spark):
    def one(number, name, city, country, credit, segment):
        return (number, name, "F", "L", "1", "A", city, None, country, credit, segment)

    data = [
        one(10000, "Alpha, Inc", "Lyon", "France", 100.25, "Enterprise"),
        one(10001, "beta", "Paris", "France", 200.25, "SMB"),
        one(10002, "Gamma", "Boston", "USA", None, "Enterprise"),
        one(10003, "delta", "Rome", "Italy", 300.5, "SMB"),
    ]
    return spark.createDataFrame(data, schemas.CUSTOMERS)


def log_line(ip, endpoint, status=200, ms=100, time="05/Nov/2025:13:01:02 +0000", method="GET"):
    return f'{ip} [{time}] "{method} {endpoint} HTTP/1.1" {status} {ms}'


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value STRING")
