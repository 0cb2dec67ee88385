"""Shards by jump consistent hashing (Lamping and Veach, 2014).

The key and the number of shards decide a row's shard, without a table of the
ring.  When a shard is appended, a row either stays or moves into the new one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tradescribe.llm.tables import numbered, ship_package, stored
from tradescribe.llm.words import mix

_NULL_KEY = 0x6A09E667F3BCC909


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = keys.astype(np.uint64).copy()
    shard = np.full(len(key), -1, dtype=np.int64)
    jump = np.zeros(len(key), dtype=np.int64)
    moving = np.arange(len(key))
    while len(moving):
        shard[moving] = jump[moving]
        key[moving] = key[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((key[moving] >> np.uint64(33)).astype(np.float64) + 1.0)
        jump[moving] = ((shard[moving] + 1) * step).astype(np.int64)
        moving = moving[jump[moving] < shards]
    return shard


def stable_key(ids: pd.Series) -> np.ndarray:
    """Integer ids as well spread 64-bit keys; null has a key of its own."""
    missing = ids.isna().to_numpy()
    key = mix(ids.fillna(0).astype("int64").to_numpy().view(np.uint64))
    key[missing] = np.uint64(_NULL_KEY)
    return key


def shard_of(key: Column, shards: int) -> Column:
    """The shard, from 0, of an integer key column."""

    @F.pandas_udf("int")
    def shard(ids: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(stable_key(ids), shards), dtype="int32")

    return shard(key.cast("long"))


def sharded(documents: DataFrame, shards: int = 24) -> DataFrame:
    """Every document's shard and place in it; columns doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `key`: doc_id and the number of shards decide alone, so equal
    texts under different ids may lie apart.  grown_shard is the shard with one
    shard more.  slot numbers a shard's rows from 0 without gaps, in an order
    that depends on the rows alone.

    A null text has size 8 and the checksum of the empty text.  A null doc_id is
    a key of its own.  Repeated rows keep a slot each.  An empty table gives no
    rows; other columns of the input are not read.
    """
    ship_package(documents.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id").cast("long")
    slim = stored(
        documents.select(
            key.alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            shard_of(key, shards).alias("shard"),
            shard_of(key, shards + 1).alias("grown_shard"),
        ),
        "shards",
    )
    rows = numbered(slim, ["shard"], ["doc_id", "size", "text_crc32", "grown_shard"], "slot")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
