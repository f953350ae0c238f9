"""Writers. Errors reach the caller; nothing is retried in another form.

A result is written to a fresh folder beside its place and takes the place only when it is
complete: the old one is put aside, the new one gets its name, then the old one goes. A job that
ends before that leaves the old result as it was. What remains of a driver that died between the
two renames is put back by ``recover``, which every write calls first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


class _Place:
    """A path, its file system, and the names beside it that Spark's readers skip."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.files = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def beside(self, kind: str, mark: str):
        name = f"_{self.path.getName()}.{kind}-{mark}"
        return self.jvm.org.apache.hadoop.fs.Path(self.path.getParent(), name)

    def rename(self, source, target) -> None:
        if not self.files.rename(source, target):
            raise OSError(f"cannot rename {source} to {target}")

    def left(self, kind: str) -> list:
        """What earlier writers left beside the path, the latest first."""
        parent = self.path.getParent()
        if not self.files.exists(parent):
            return []
        start = f"_{self.path.getName()}.{kind}-"
        found = [s for s in self.files.listStatus(parent) if s.getPath().getName().startswith(start)]
        return [s.getPath() for s in sorted(found, key=lambda s: -s.getModificationTime())]


def recover(spark: SparkSession, path: str) -> bool:
    """End what a driver left that died while it published to ``path``.

    Without a result there, the old one is put back, and True returned; with one, what was
    put aside is deleted. Unfinished results are deleted. For one writer of a path at a time.
    """
    place = _Place(spark, path)
    aside = place.left("old")
    back = bool(aside) and not place.files.exists(place.path)
    if back:
        place.rename(aside.pop(0), place.path)
    for folder in aside + place.left("new"):
        place.files.delete(folder, True)
    return back


def publish(spark: SparkSession, write: Callable[[str], None], path: str) -> None:
    """Let ``write`` fill a fresh folder, then make that the result at ``path``.

    If ``write`` fails, the folder goes and the old result stays. ``write`` may read the old one.
    """
    recover(spark, path)
    place, mark = _Place(spark, path), uuid.uuid4().hex
    fresh, old = place.beside("new", mark), place.beside("old", mark)
    try:
        write(fresh.toString())
    except BaseException:
        place.files.delete(fresh, True)
        raise
    if place.files.exists(place.path):
        place.rename(place.path, old)
    try:
        place.rename(fresh, place.path)
    except BaseException:
        recover(spark, path)
        raise
    place.files.delete(old, True)


def write_report(report: DataFrame, path: str) -> None:
    """Write a metric report as one CSV file with a header, replacing ``path``.

    For aggregated reports of a few rows only: the last step runs in one task.
    Tables, filtered ones too, go through ``write_dataset``.
    """
    writer = report.coalesce(1).write.option("header", True)
    publish(report.sparkSession, writer.csv, path)


def write_dataset(
    table: DataFrame,
    path: str,
    format: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Write a table as many files, one or more per task, replacing ``path``.

    The table may be one that reads from ``path``.
    """
    writer = table.write.format(format)
    if format == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    publish(table.sparkSession, writer.save, path)
