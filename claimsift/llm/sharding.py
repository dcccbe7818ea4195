"""Operator 6: documents put into shards by jump consistent hashing of their key.

A key walks through the shards it would jump to as shards are appended, and stays in the last one that exists. There is no
table of shards, and one more shard takes over its share of rows without any other row moving.
"""

from __future__ import annotations

import pandas as pd
import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from claimsift.llm.common import ready, running, staged

#: Fixed values of the published algorithm: a 64-bit linear congruential generator.
MULTIPLIER, INCREMENT = 2862933555777941757, 1
LAW = "key"


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key."""
    state = keys.astype(np.uint64, copy=True)
    shard, after = np.full(len(state), -1, np.int64), np.zeros(len(state), np.int64)
    going = np.arange(len(state))
    while len(going):
        shard[going] = after[going]
        state[going] = state[going] * np.uint64(MULTIPLIER) + np.uint64(INCREMENT)
        step = float(1 << 31) / ((state[going] >> np.uint64(33)).astype(np.float64) + 1.0)
        after[going] = ((shard[going] + 1) * step).astype(np.int64)
        going = going[after[going] < shards]
    return shard


def stable_key(doc_id: Column) -> Column:
    """A 64-bit key from the first half of the MD5 of the id as text, the same in any session; null is the empty text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    high, low = (F.conv(F.substring(digest, i, 8), 16, 10).cast("long") for i in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def shard_of(key: Column, shards: int) -> Column:
    @pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy().view(np.uint64), shards).astype(np.int32))

    return jump(key)


def assign_shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row of ``docs``.

    Id and number of shards alone decide the shard, so copies of a text go wherever their ids do. ``grown_shard`` is the
    shard with one more. ``size`` is the bytes of the text plus one. A null text counts as no bytes, a null id as a key of
    its own. ``slot`` numbers the rows of a shard from 0 in the order of id, checksum and size; rows that repeat all of
    these may swap. Slots come from running totals over ranges, so no task holds a shard. An empty table gives no rows.
    """
    ready(docs.sparkSession)
    raw = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    key = stable_key(F.col(doc_id))
    keyed = docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.lit(LAW).alias("law"), shard_of(key, shards).alias("shard"), shard_of(key, shards + 1).alias("grown_shard"))
    order = [F.col(c) for c in ("shard", "doc_id", "text_crc32", "size")]
    numbered = staged(running(keyed, order, {"place": F.lit(1)}, "keys"), "places")
    starts = numbered.groupBy("shard").agg(F.min("place").alias("start"))
    return numbered.join(F.broadcast(starts), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("place") - F.col("start")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """``docs`` as one folder per shard. Ids must be unique here, as they lead from the assignment back to the rows."""
    found = assigned.select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"))
    joined = docs.join(found, docs[doc_id].eqNullSafe(found["_id"])).drop("_id")
    joined.hint("rebalance", "_shard").write.mode("overwrite").partitionBy("_shard").parquet(path)
