"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import (
    best_fit,
    decontaminate,
    length_buckets,
    merkle_manifest,
    near_duplicates,
    personal_data,
    pipeline,
    quality,
    repeats,
    secrets,
    token_groups,
    vector_codes,
    vector_shards,
    warc_bundles,
)
from shoplens.llm.common import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.rate(_table(spark, sf_dir, "documents")).drop("n_lines", "n_echoes")


def op2_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds."""
    return decontaminate.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op3_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near duplicates."""
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op4_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 24 and its place there."""
    return vector_shards.assign(_table(spark, sf_dir, "documents"))


def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the packed matrices of all documents."""
    return best_fit.pack(_table(spark, sf_dir, "documents"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated passages leave of every document."""
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"), with_kept=False)


def op7_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, written to archives and read back."""
    return warc_bundles.round_trip(_table(spark, sf_dir, "pages"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return personal_data.find_personal_data(_table(spark, sf_dir, "documents"))


def op10_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of all documents with their sequences."""
    pieces = length_buckets.cut_documents(_table(spark, sf_dir, "documents"), with_ids=False)
    return length_buckets.pack(pieces.drop("ids"))


def op11_octopus_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf in the manifest and its proof."""
    return merkle_manifest.prove(_table(spark, sf_dir, "documents"))


def op12_resident_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code and what it loses."""
    return vector_codes.code_table(_table(spark, sf_dir, "embeddings"))


def op13_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of similar documents."""
    return token_groups.similarity_classes(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_limits": op1_quality_limits,
        "op2_spaced_seeds": op2_spaced_seeds,
        "op3_super_minhash": op3_super_minhash,
        "op4_vector_shards": op4_vector_shards,
        "op5_best_fit": op5_best_fit,
        "op6_repeats": op6_repeats,
        "op7_warc_bundles": op7_warc_bundles,
        "op8_secret_scan": op8_secret_scan,
        "op9_personal_data": op9_personal_data,
        "op10_length_buckets": op10_length_buckets,
        "op11_octopus_manifest": op11_octopus_manifest,
        "op12_resident_lloyd": op12_resident_lloyd,
        "op13_token_groups": op13_token_groups,
        "pipeline": pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_limits": quality.SQL,
        "op2_spaced_seeds": decontaminate.SQL,
        "op3_super_minhash": near_duplicates.SQL,
        "op6_repeats": repeats.SQL,
        "op7_warc_bundles": warc_bundles.SQL,
        "op8_secret_scan": secrets.SQL,
        "op11_octopus_manifest": merkle_manifest.SQL,
        "op12_resident_lloyd": vector_codes.SQL,
        "op13_token_groups": token_groups.SQL,
    }
