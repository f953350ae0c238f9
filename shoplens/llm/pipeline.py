"""From raw documents to packed training sequences, in stages that are written and read again.

Quality rules drop documents, near-duplicate search keeps one of each group, decontamination
drops what holds a benchmark passage, the secret scan redacts, and packing cuts the rest into
sequences. Each stage works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import decontaminate, length_buckets, near_duplicates, quality, secrets
from shoplens.llm.common import fresh_folder, ship

#: Words of a shingle of the near-duplicate stage; four, as in operator 3, link more loosely.
SHINGLE = 5


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits of their language and source."""
    return quality.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return near_duplicates.keep_one(docs, shingle=SHINGLE)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by what they were; n_chars is counted anew."""
    return secrets.redact_secrets(docs, length="n_chars")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return length_buckets.pack(length_buckets.cut_documents(docs, with_ids=False).drop("ids"))


def _shipped(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(ship(spark), docs, sf_dir)

    run_stage.__doc__ = stage.__doc__
    return run_stage


STAGES = [
    ("quality rules", _shipped(good_documents)),
    ("near duplicates", _shipped(one_of_each)),
    ("decontamination", _shipped(without_benchmark)),
    ("secret scan", _shipped(without_secrets)),
    ("packing", _shipped(sequences)),
]

#: Components of near duplicates and token ids are out of reach of SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``; what they keep lies in the shared folder."""
    folder = fresh_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
