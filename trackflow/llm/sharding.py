"""Shards by jump consistent hashing.

A stable key decides its shard together with the number of shards; no ring table is kept. Adding a
shard moves about 1 in (shards + 1) keys, all of them into the new shard.

Places within a shard are gapless. Rows are numbered within (input partition, shard), which no key
can make larger than an input partition, and the counts of those groups are summed up per shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow.llm.shared import stored


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, by the algorithm of Lamping and Veach."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    jump = np.zeros(len(state), np.int64)
    while len(active):
        shard[active] = jump
        state = state * np.uint64(2862933555777941757) + np.uint64(1)
        scale = float(1 << 31) / ((state >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        jump = ((shard[active] + 1) * scale).astype(np.int64)
        on = jump < shards
        active, state, jump = active[on], state[on], jump[on]
    return shard.astype(np.int32)


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a key of any type; all null keys share one shard."""
    if shards < 1:
        raise ValueError("shards must be positive")

    @F.pandas_udf("int")
    def place(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashed.to_numpy(np.int64).view(np.uint64), shards))

    return place(F.xxhash64(key))


def numbered(df: DataFrame, group: str, into: str, order: list[str]) -> DataFrame:
    """A gapless number from 0 for the rows of each group; the partition of input leads the order."""
    df = stored(df.withColumn("_part", F.spark_partition_id()), "numbered")
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy(group, "_part").count().select(
        group, "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    local = F.row_number().over(Window.partitionBy("_part", group).orderBy(*order)) - 1
    return (
        df.join(starts, [group, "_part"])
        .withColumn(into, (F.col("_start") + local).cast("long"))
        .drop("_start", "_part")
    )


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's bytes plus 8. A null text counts as no bytes; null keys are one key. Repeated
    rows stay, each in a place of its own. Other columns of the input are not carried."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key),
        (F.octet_length(data) + 8).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump_shard(F.col(key), shards).alias("shard"),
        jump_shard(F.col(key), shards + 1).alias("grown_shard"),
    )
    out = numbered(rows, "shard", "slot", [key, "text_crc32", "size"])
    return out.select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
