"""What several of the operators share: shared storage, size-checked joins, row numbers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a two-column table may be broadcast (16 bytes a row, so 8 MB).
BROADCAST_ROWS = 500_000


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_shoplens_shipped", False):
        return spark
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, name = os.path.split(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="shoplens-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, files in os.walk(package):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    packed.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    context._shoplens_shipped = True
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is what the session names in ``spark.checkpoint.dir``. Only where that is unset and the
    session runs on one machine, as in tests, a temporary folder takes its place.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        folder = context.getCheckpointDir()
        if not folder:
            if context.master.split("[")[0] != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="shoplens-"))
            folder = context.getCheckpointDir()
    return folder.rstrip("/")


def settle(frame: DataFrame) -> DataFrame:
    """The rows, computed once and written to the shared folder.

    The lineage is cut, and a lost executor costs nothing but a second read.
    """
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def fresh_folder(spark: SparkSession, kind: str) -> str:
    """A name in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def small_side(frame: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``frame`` marked for broadcast if it has at most ``limit`` rows, else as it is.

    Counts it, so it should be settled or read from a table.
    """
    return F.broadcast(frame) if frame.count() <= limit else frame


def text_bytes(text: str) -> Column:
    """A text column as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")

