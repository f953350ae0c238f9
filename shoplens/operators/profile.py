"""Profiling of any table: counts, nulls, duplicates, distributions, statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from shoplens.functions import exact_average, exact_sum, not_finite, percentage


def named(column: str) -> Column:
    """A top-level column by its exact name, dots and blanks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), a row per table."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def null_counts(table: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of nulls of each column, in one pass."""
    return table.agg(
        *[F.count_if(named(c).isNull()).alias(c) for c in columns or table.columns]
    )


def duplicate_keys(table: DataFrame, key: str) -> DataFrame:
    """(total, distinct_ids, duplicates); null is an id like any other.

    Rows are counted per id first, so a frequent id leaves each task as one row.
    """
    per_id = table.groupBy(named(key)).agg(F.count(F.lit(1)).alias("n"))
    counted = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("distinct_ids"),
    )
    return counted.withColumn("duplicates", F.col("total") - F.col("distinct_ids"))


def distinct_values(table: DataFrame, column: str) -> DataFrame:
    """The values of a column, null included if it occurs."""
    return table.select(named(column)).distinct()


def value_counts(table: DataFrame, *keys: str, top: int | None = None) -> DataFrame:
    """Rows per combination of ``keys``, most frequent first, ties by key."""
    columns = [named(key) for key in keys]
    counted = table.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))
    ordered = counted.orderBy(F.desc("count"), *columns)
    return ordered if top is None else ordered.limit(top)


def numeric_stats(
    table: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    digits: int = 2,
    scale: int = 6,
    odd: bool = False,
) -> DataFrame:
    """count, sum, min, max and avg of each column as ``<column>_<statistic>``.

    With ``odd`` also how many values are NaN or infinite; see ``exact_sum`` for their effect.

    The count leaves nulls out. Values are added as decimals with ``scale`` digits after the
    point, so sums and averages do not depend on the order in which tasks add; both are rounded
    to ``digits`` and given as doubles.
    """
    stats = []
    for column in columns:
        value = named(column)
        stats += [
            F.count(value).alias(f"{column}_count"),
            exact_sum(value, scale, digits).alias(f"{column}_sum"),
            F.min(value).alias(f"{column}_min"),
            F.max(value).alias(f"{column}_max"),
            F.round(exact_average(value, scale), digits).alias(f"{column}_avg"),
        ]
        if odd:
            stats.append(not_finite(value).alias(f"{column}_odd"))
    return table.groupBy(*[named(key) for key in by]).agg(*stats)


def top_groups(
    table: DataFrame,
    key: str,
    value: str,
    name: str,
    k: int = 1,
    digits: int = 2,
    scale: int = 6,
) -> DataFrame:
    """The ``k`` groups with the largest sum of ``value``, ties by key.

    Whole numbers are added as such, others as decimals with ``scale`` digits after the point
    and rounded to ``digits``. So the winner does not depend on the order in which tasks add.
    """
    whole = isinstance(table.schema[value].dataType, IntegralType)
    amount = named(value)
    total = F.sum(amount) if whole else exact_sum(amount, scale, digits)
    summed = table.groupBy(named(key)).agg(total.alias(name))
    return summed.orderBy(named(name).desc(), named(key)).limit(k)


def share(table: DataFrame, predicate: Column, name: str = "segment_count") -> DataFrame:
    """(name, total, pct): rows for which ``predicate`` holds, in one pass."""
    counted = table.agg(
        F.count_if(predicate).alias(name), F.count(F.lit(1)).alias("total")
    )
    return counted.withColumn("pct", percentage(named(name), F.col("total")))


def partition_sizes(table: DataFrame) -> DataFrame:
    """(partition_id, row_count) of the non-empty partitions."""
    return table.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
