"""Sharding by jump consistent hashing.

The shard of a key follows from the key and the number of shards alone. Appending a shard moves the fraction
1 / (n + 1) of the keys, all of them into the new shard.

Slots count each shard's rows in order of md5 of doc_id and text, by prefix sums over buckets of that order, so the
rows of a shard, or of one doc_id, spread over many tasks.

Defined cases: a null doc_id is the key 0 and sorts as the empty string; a null text has no bytes; repeated rows go to
one shard and get slots of their own; an empty table gives an empty result; other columns are ignored by assign() and
carried by write_shards().
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_bits, content_order, keep, running, whole_text

#: The multiplier of the published algorithm (Lamping and Veach, 2014).
STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, 0 to shards - 1, of each 64-bit key."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    out = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        state[live] = state[live] * STEP + np.uint64(1)
        nxt = np.floor((out[live] + 1) * (2.0**31 / ((state[live] >> np.uint64(33)).astype(np.float64) + 1.0)))
        ok = nxt < shards
        live = live[ok]
        out[live] = nxt[ok].astype(np.int64)
    return out


def shard_of(key: Column, shards: int) -> Column:
    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.fillna(0).to_numpy(np.int64), shards).astype(np.int32))

    return place(F.coalesce(key, F.lit(0)).cast("long"))


def assign(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard. Texts are read once, into a narrow table."""
    text = whole_text()
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), shards).alias("shard"), shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"),
        content_order().alias("_order"), F.lit(1).cast("long").alias("_one"),
    )
    rows = keep(rows, "shards")
    out = running(rows, "shard", "_order", ["doc_id"], "_one", "slot", bucket_bits(rows.count() // shards))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """Writes docs under path, a folder shard=N for each shard."""
    docs.withColumn("shard", shard_of(F.col("doc_id"), shards)).write.partitionBy("shard").parquet(path)
