"""Customer selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def segment_customers(
    customers: DataFrame,
    segment: str = "Enterprise",
    columns: Sequence[str] = ("customerName", "phone", "city", "country"),
) -> DataFrame:
    """``columns`` of a segment's customers, and their name in upper case."""
    return (
        customers.where(F.col("customerSegment") == segment)
        .select(*columns)
        .withColumn("customerNameUpper", F.upper("customerName"))
    )


def customers_in_country(customers: DataFrame, country: str = "USA") -> DataFrame:
    return customers.where(F.col("country") == country)
