"""The people table: name, age, city, salary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import exact_average


def people_over(people: DataFrame, age: int = 30) -> DataFrame:
    return people.where(F.col("age") > age)


def average_salary_by_city(people: DataFrame) -> DataFrame:
    return people.groupBy("city").agg(exact_average(F.col("salary")).alias("avg_salary"))
