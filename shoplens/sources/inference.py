"""Column types of delimited text, found in one aggregation.

Types form a lattice: each value allows a kind, and the type of a column is the least one above
the kinds of all its values. What a task has seen of a column is a set of kinds, one bit each;
sets merge by a bitwise or, so any number of tasks and files give the same types.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

#: The kinds of values, one bit each.
INT, LONG, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << k for k in range(7))

WHOLE = r"^[+-]?[0-9]{1,40}$"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?$"

#: The kinds that each type allows, the narrowest type first. A column without a value is text.
LATTICE: tuple[tuple[int, DataType], ...] = (
    (0, StringType()),
    (INT, IntegerType()),
    (INT | LONG, LongType()),
    (INT | LONG | DOUBLE, DoubleType()),
    (DATE, DateType()),
    (DATE | TIMESTAMP, TimestampType()),
    (BOOLEAN, BooleanType()),
)


def kind_of(text: Column) -> Column:
    """The kind of a value; 0 for null and the empty text.

    Whole numbers beyond a long are doubles. Days and times must exist. White space makes text.
    """
    whole = F.when(text.try_cast("int").isNotNull(), INT).when(
        text.try_cast("bigint").isNotNull(), LONG
    )
    return (
        F.when(text.isNull() | (text == ""), 0)
        .when(text.rlike(WHOLE), whole.otherwise(DOUBLE))
        .when(text.rlike(NUMBER) | text.isin("NaN", "Infinity", "-Infinity"), DOUBLE)
        .when(text.rlike(DAY) & text.try_cast("date").isNotNull(), DATE)
        .when(text.rlike(INSTANT) & text.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def type_of(kinds: int) -> DataType:
    """The narrowest type that allows a set of kinds."""
    return next((kind for allowed, kind in LATTICE if not kinds & ~allowed), StringType())


def _type_name(kinds: Column) -> Column:
    """``type_of`` as a column of type names."""
    named = F.lit(None).cast("string")
    for allowed, kind in LATTICE:
        fits = kinds.bitwiseAND(127 ^ allowed) == 0
        named = F.coalesce(named, F.when(fits, kind.simpleString()))
    return F.coalesce(named, F.lit("string"))


def column_types(table: DataFrame) -> DataFrame:
    """(position, column, type, n_values): what the text of each column of a table allows.

    One aggregation over the table; ``n_values`` leaves out nulls and empty texts.
    """
    kinds, counts = [], []
    for at, name in enumerate(table.columns):
        kind = kind_of(F.col(f"`{name}`").cast("string"))
        kinds.append(F.coalesce(F.bit_or(kind), F.lit(0)).alias(f"k{at}"))
        counts.append(F.count_if(kind != 0).alias(f"n{at}"))
    rows = [
        F.struct(
            F.lit(at).cast("bigint").alias("position"),
            F.lit(name).alias("column"),
            _type_name(F.col(f"k{at}")).alias("type"),
            F.col(f"n{at}").alias("n_values"),
        )
        for at, name in enumerate(table.columns)
    ]
    return table.agg(*kinds, *counts).select(F.inline(F.array(*rows)))


def infer_schema(
    spark: SparkSession, path: str | Sequence[str], sep: str = ",", header: bool = True
) -> StructType:
    """The schema of delimited files, for ``read_table``; reads all values once.

    Names come from the header line of the first file; without one they are ``_c0``, ``_c1``.
    """
    text = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("inferSchema", False)
        .csv(path if isinstance(path, str) else list(path))
    )
    kinds = {
        row["column"]: row["type"] for row in column_types(text).collect()
    }
    by_name = {kind.simpleString(): kind for _, kind in LATTICE}
    return StructType([StructField(name, by_name[kinds[name]]) for name in text.columns])
