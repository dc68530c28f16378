"""Shards by jump consistent hashing of a stable key, and gapless places in them."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binledger.operators.copies import count_copies

PARTS = 1024  # of each shard
_AT_ONCE = 65_536


def jump_hash(keys: np.ndarray, n: int) -> np.ndarray:
    """Shard 0 to n - 1 of each unsigned 64-bit key. With n + 1 shards a key keeps its
    shard or goes to the new one, and about one key in n + 1 does."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    jump = np.zeros(len(state), np.float64)
    while len(moving):
        shard[moving] = jump[moving].astype(np.int64)
        state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        chance = ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        jump[moving] = np.floor((shard[moving] + 1) * (float(1 << 31) / chance))
        moving = moving[jump[moving] < n]
    return shard.astype(np.int32)


def shard_of(key, n: int):
    """Column: the shard of a key column under ``n`` shards. Keys of any type are
    hashed; a missing key has a shard as any other."""
    if n < 1:
        raise ValueError("at least one shard")

    @F.arrow_udf("int")
    def shard(hashes: pa.Array) -> pa.Array:
        return pa.array(jump_hash(hashes.to_numpy(zero_copy_only=False).view(np.uint64), n), pa.int32())

    return shard(F.xxhash64(key))


def place_in_shards(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = 40) -> DataFrame:
    """One row per row of ``df``: the key, size (UTF-8 bytes of the text plus 16),
    text_crc32, shard, slot (0, 1, 2, ... in each shard, in no stated order) and
    grown_shard (the shard if there were one more).

    Key and number of shards alone decide, so rows of one key, copies included, share
    a shard. A missing text counts as an empty one; a missing key counts as a
    key; no rows give no rows. Other columns are not read.

    Equal rows are counted before the shuffle. A shard is numbered in
    ``PARTS`` parts; the parts' totals, n x PARTS rows, give each its first slot.
    """
    column, value = F.col(f"`{key}`"), F.col(f"`{text}`")
    rows = df.select(
        column.alias(key),
        (F.coalesce(F.octet_length(value), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(value, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    part = F.pmod(F.xxhash64(F.col(f"`{key}`"), "size", "text_crc32"), F.lit(PARTS)).cast("int")
    counted = count_copies(rows, "copies").withColumns(
        {
            "shard": shard_of(F.col(f"`{key}`"), n),
            "grown_shard": shard_of(F.col(f"`{key}`"), n + 1),
            "part": part,
        }
    )
    totals = counted.groupBy("shard", "part").agg(F.sum("copies").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    before = (
        Window.partitionBy("shard", "part")
        .orderBy(F.col(f"`{key}`"), "size", "text_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = counted.withColumn("before", F.coalesce(F.sum("copies").over(before), F.lit(0))).join(
        F.broadcast(first), ["shard", "part"]  # n x PARTS rows at most
    )
    pieces = placed.withColumn("piece", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {_AT_ONCE}"))))
    within = F.sequence(F.lit(0), F.least(F.lit(_AT_ONCE), F.col("copies") - F.col("piece") * _AT_ONCE) - 1)
    return pieces.hint("rebalance").withColumn("copy", F.explode(within)).select(
        F.col(f"`{key}`"),
        "size",
        "text_crc32",
        "shard",
        (F.col("first") + F.col("before") + F.col("piece") * _AT_ONCE + F.col("copy")).cast("long").alias("slot"),
        "grown_shard",
    )
