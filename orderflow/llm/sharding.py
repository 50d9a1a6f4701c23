"""Placement of keys on shards by a permutation-filled lookup table (operator 4).

Every shard has its own order of preference over the slots of a table of prime size. The shards
take turns, each claiming the first slot of its order that is still free, until all slots are
taken. So slot counts differ by one at most, and when a shard leaves, nearly all keys of the
others stay where they are. A key's slot is its hash modulo the table size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import column, unused

TABLE_SIZE = 65537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: Sequence[str], size: int = TABLE_SIZE) -> np.ndarray:
    """The shard number of each slot. Repeated names, no names, a size that is not prime or
    smaller than the number of shards are errors."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, one at least")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the table size must be a prime, and no smaller than the shards")
    digests = [hashlib.md5(name.encode()).digest() for name in shards]
    offsets = [int.from_bytes(d[:8], "big") % size for d in digests]
    # A step from 1 to size - 1 visits all slots, since size is prime.
    steps = [int.from_bytes(d[8:], "big") % (size - 1) + 1 if size > 2 else 1 for d in digests]
    table, at = [-1] * size, offsets
    taken = 0
    while True:
        for shard, step in enumerate(steps):
            slot = at[shard]
            while table[slot] >= 0:
                slot = (slot + step) % size
            table[slot] = shard
            at[shard] = (slot + step) % size
            taken += 1
            if taken == size:
                return np.array(table, np.int32)


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The first 60 bits of the key's MD5 modulo the table size; a null key counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % size


def place(
    df: DataFrame, key_col: str, shards: Sequence[str], size: int = TABLE_SIZE
) -> DataFrame:
    """df with slot (long) and shard (its name), replacing columns of these names.

    One row per row of df; equal keys go to the same shard, null keys to that of the empty
    text. The table is broadcast: it has size rows whatever df has.
    """
    key, name = unused("_key", df), unused("_name", df)
    table = df.sparkSession.createDataFrame(
        [(slot, shards[shard]) for slot, shard in enumerate(fill(shards, size).tolist())],
        f"{key} long, {name} string",
    )
    kept = df.withColumn(key, slot_of(column(key_col), size))
    rest = [column(c) for c in df.columns if c.lower() not in ("slot", "shard")]
    placed = kept.join(F.broadcast(table), key)
    return placed.select(column(key).alias("slot"), *rest, column(name).alias("shard"))


def write(df: DataFrame, key_col: str, shards: Sequence[str], path: str) -> None:
    """One folder of Parquet files per shard; large shards are written by several tasks."""
    place(df, key_col, shards).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
