"""CSV and text readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """Read delimited files with a header line, columns by position.

    The schema's names win over those in the files. Values that do not fit
    their type become null. One file splits over many tasks, so quoted values
    must not contain line breaks; ``read_table_of_records`` reads those that do, and
    ``infer_schema`` finds a schema.
    """
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .csv(path if isinstance(path, str) else list(path))
    )


def table_quality(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """One row: ``rows``, ``damaged_rows`` and, per column, values that ``read_table`` loses.

    Rows with too few or too many fields are damaged; their fields count, too. The files are
    read once, as text, and each value is tried as its column's type.
    """
    text = StructType([StructField(field.name, StringType()) for field in schema])
    damage = "_damaged"
    raw = (
        spark.read.schema(StructType([*text, StructField(damage, StringType())]))
        .option("header", header)
        .option("sep", sep)
        .option("columnNameOfCorruptRecord", damage)
        .csv(path if isinstance(path, str) else list(path))
    )
    lost = [
        F.count_if(
            F.col(f"`{field.name}`").isNotNull()
            & F.col(f"`{field.name}`").try_cast(field.dataType).isNull()
        ).alias(field.name)
        for field in schema
    ]
    return raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(damage).isNotNull()).alias("damaged_rows"),
        *lost,
    )


def load_table(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    sep: str = ",",
    rename: Mapping[str, str] | None = None,
    cache: bool = False,
) -> DataFrame:
    """``read_table``, then rename the columns present in ``rename``.

    With ``cache`` the table is kept on the executors after its first use and
    spills to their disks; call ``unpersist()`` when done with it.
    """
    table = read_table(spark, path, schema, sep)
    if rename:
        table = table.withColumnsRenamed(dict(rename))
    return table.persist(StorageLevel.MEMORY_AND_DISK) if cache else table


def read_lines(spark: SparkSession, path: str | Sequence[str], cache: bool = False) -> DataFrame:
    """Read text files as one string column, ``value``, a row per line."""
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    return lines.persist(StorageLevel.MEMORY_AND_DISK) if cache else lines
