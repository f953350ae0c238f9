"""Delimited files whose quoted values hold line breaks, split over many tasks.

A quote opens or closes a value, so a line break ends a record where the number of quotes before
it in the file is even. Each split counts its quotes; the running parity of those counts tells
each split whether it begins within a value. Then every task puts its lines together, and only
records that cross the end of a split are joined from their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Splits of all files together; their parities (about 24 bytes each) are sent to all tasks.
MOST_SPLITS = 4_000_000

#: Pieces of a split: the end of a record from before, nothing but the inside of one, the
#: beginning of one that goes on behind it, and whole records.
END, INSIDE, BEGIN, WHOLE = range(4)

_PIECES = "file bigint, block bigint, kind int, value string"


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """value, file, block: the lines of all files, in order within each split."""
    lines = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    return lines.select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _quotes(text: Column, quote: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(quote), F.lit("")))


def split_parities(lines: DataFrame, quote: str = '"') -> DataFrame:
    """file, block, inside: whether each split begins within a quoted value."""
    counted = lines.groupBy("file", "block").agg(
        (F.sum(_quotes(F.col("value"), quote)) % 2).alias("odd")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return counted.select(
        "file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside")
    )


def _pieces(quote: str):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The records and pieces of records of each split, which comes in order."""
        now, held, inside, begun = None, [], False, BEGIN
        out: list[tuple[int, int, int, str]] = []

        def close(kind: int) -> None:
            out.append((*now, kind, "\n".join(held)))
            held.clear()

        def end_split() -> None:
            if held:
                close(begun)

        for batch in batches:
            for value, file, block, within in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if (file, block) != now:
                    end_split()
                    # a split that begins within a value goes on with a record from before
                    now, inside, begun = (file, block), within, INSIDE if within else BEGIN
                held.append(value)
                inside ^= value.count(quote) % 2 == 1
                if not inside:
                    close(END if begun == INSIDE else WHOLE)
                    begun = BEGIN
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in out], pa.int64()),
                    pa.array([r[1] for r in out], pa.int64()),
                    pa.array([r[2] for r in out], pa.int32()),
                    pa.array([r[3] for r in out], pa.string()),
                ],
                ["file", "block", "kind", "value"],
            )
            out.clear()
        end_split()
        if out:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("file", "block", "kind", "value"), r, strict=True)) for r in out],
                pa.schema(
                    [
                        ("file", pa.int64()),
                        ("block", pa.int64()),
                        ("kind", pa.int32()),
                        ("value", pa.string()),
                    ]
                ),
            )

    return pieces


def read_records(
    spark: SparkSession, path: str | Sequence[str], quote: str = '"'
) -> DataFrame:
    """Files as one string column ``value``, a row per record with its line breaks.

    The files are read as text three times: to count quotes, for whole records and for the pieces
    of the few that cross the end of a split, one or two of each split. Every quote counts, so
    quotes within a value must be doubled. A file whose last quote is never closed ends in one
    record. Blank records are left out; a carriage return at the end of a record is, too.
    """
    lines = _lines(spark, path)
    parities = split_parities(lines, quote).limit(MOST_SPLITS + 1).toArrow()
    if len(parities) > MOST_SPLITS:
        raise ValueError("too many splits; raise spark.sql.files.maxPartitionBytes")
    # a broadcast also keeps the order of the lines of a split
    known = spark.createDataFrame(parities)
    placed = lines.join(F.broadcast(known), ["file", "block"]).select(
        "value", "file", "block", "inside"
    )
    pieces = placed.mapInArrow(_pieces(quote), _PIECES)
    whole = pieces.filter(F.col("kind") == WHOLE).select("value")
    # in a split an end comes before a beginning
    order = Window.partitionBy("file").orderBy("block", "kind")
    crossing = (
        pieces.filter(F.col("kind") != WHOLE)
        .withColumn("record", F.sum(F.when(F.col("kind") == BEGIN, 1).otherwise(0)).over(order))
        .groupBy("file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("block", "kind", "value"))).alias("parts"))
        .select(F.array_join("parts.value", "\n").alias("value"))
    )
    return (
        whole.union(crossing)
        .select(F.rtrim(F.col("value"), F.lit("\r")).alias("value"))
        .filter(F.trim("value") != "")
    )


def read_table_of_records(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    sep: str = ",",
    header: bool = True,
    quote: str = '"',
) -> DataFrame:
    """``read_table`` for files whose quoted values hold line breaks; see ``read_records``.

    With ``header`` records that spell the first line of the first file are left out.
    """
    records = read_records(spark, path, quote)
    if header:
        first = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
        names = first.limit(1).collect()
        if names:
            records = records.filter(F.col("value") != names[0]["value"].rstrip("\r"))
    options = {"sep": sep, "quote": quote, "escape": quote, "multiLine": "true"}
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parsed = F.from_csv("value", columns, options)
    return records.select(parsed.alias("row")).select("row.*")
