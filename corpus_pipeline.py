"""The corpus pipeline: toxicity, exact dedup, near dedup, mixing, packing.

run(spark, sf_dir) applies STAGES to the documents table, writing each stage's rows to the shared folder and
rereading them as the next one's input. All stages but the last return the columns of documents; the last returns
the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapstate.llm import exact, mixing, near, packing, toxicity
from snapstate.llm.common import documents, drop_kept, keep


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row with the smallest doc_id stays."""
    return near.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, in the order of training."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("mixing", mix_sources), ("packing", pack_sequences)]

#: Neither the boosted trees nor the tokenizer can be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    last = None
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
        if last is not None:
            drop_kept(last)
        last = docs
    return docs
