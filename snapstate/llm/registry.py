"""The queries of this subpackage, and SQL for those that SQL can express on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact, langid, media, mixing, near, packing, pii, shards, suffix, toxicity
from .common import documents
from .oracle import oracle_sql  # noqa: F401  part of this module's interface


def op1_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.report(documents(spark, sf_dir))


def op4_bloom_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicate_report(documents(spark, sf_dir))


def op5_netpbm_bmp_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.report(documents(spark, sf_dir))


def op6_jump_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(documents(spark, sf_dir))


def op7_odd_sketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.report(documents(spark, sf_dir))


def op8_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(documents(spark, sf_dir))


def op9_centroid_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(documents(spark, sf_dir))


def op10_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_skip_chain_pii": op1_skip_chain_pii,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_suffix_array_dedup": op3_suffix_array_dedup,
        "op4_bloom_exact_dedup": op4_bloom_exact_dedup,
        "op5_netpbm_bmp_media": op5_netpbm_bmp_media,
        "op6_jump_hash_shards": op6_jump_hash_shards,
        "op7_odd_sketch_near_dedup": op7_odd_sketch_near_dedup,
        "op8_curriculum_mixing": op8_curriculum_mixing,
        "op9_centroid_langid": op9_centroid_langid,
        "op10_boosted_toxicity": op10_boosted_toxicity,
    }
