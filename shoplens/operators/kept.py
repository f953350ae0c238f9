"""Totals that are kept: a type of their own, so that no column name has to tell them apart."""

from __future__ import annotations

from typing import Self

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame


class Totals:
    """A table of totals. Analyses that take requests take it in their place."""

    def __init__(self, table: DataFrame):
        self.table = table

    def where(self, condition: Column) -> Self:
        return type(self)(self.table.where(condition))

    def persist(self) -> Self:
        """Keep the table on the executors after its first use; ``unpersist()`` when done."""
        self.table.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def unpersist(self) -> None:
        self.table.unpersist()
