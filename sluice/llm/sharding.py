"""Sharding by jump consistent hashing, in DataFrame functions only.

A key's shard depends on the key and the number of shards alone; there is no ring table. Going from n to
n + 1 shards moves about 1/(n + 1) of the keys, all of them into the new shard.

Jump consistent hash walks the increasing sequence of shard counts at which a key would move; the last one
below ``shards`` is the key's shard. Each step draws the next pseudo-random number of the key. Spark's
``xxhash64`` serves as the generator (Spark's ANSI arithmetic has no wrapping product, which the usual
linear congruential generator needs).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from sluice.llm.common import running_sum, stage

#: Rows of a shard that share a window when slots are numbered.
ROWS_PER_CHUNK = 20_000


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 .. ``shards`` - 1 of ``key`` (any hashable type; null keys share one shard).

    The expected number of steps is about ln(shards) + 1. A fold over a few times as many steps settles
    nearly every key; a key that isn't settled by then takes the fold over ``shards`` steps, which always
    suffices, because every step moves at least one shard on.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")

    def step(acc, _):
        drawn = F.xxhash64(acc["k"])
        share = (F.shiftrightunsigned(drawn, 33) + 1).cast("double") / F.lit(float(1 << 31))
        # (j + 1) / share is at most 2^31 * shards, so the cast can't overflow
        nxt = F.floor((acc["j"] + 1).cast("double") / share).cast("bigint")
        moved = F.struct(drawn.alias("k"), acc["j"].alias("b"), nxt.alias("j"))
        return F.when(acc["j"] < shards, moved).otherwise(acc)

    start = F.struct(F.xxhash64(key).alias("k"), F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"))
    some = min(shards, 8 * max(1, math.ceil(math.log2(shards + 1))))
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(some)), start, step)
    if some < shards:
        rest = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)
        return F.when(walk["j"] >= shards, walk["b"]).otherwise(rest["b"]).cast("int")
    return walk["b"].cast("int")


def with_shard(df: DataFrame, key: str, shards: int, out: str = "shard") -> DataFrame:
    """``df`` with the shard of each row; no shuffle. An existing column ``out`` is replaced."""
    return df.withColumn(out, jump_shard(F.col(key), shards))


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """Rows in folders ``shard=0`` .. under ``path``; a hot shard is split over several files."""
    with_shard(df, key, shards).hint("rebalance", "shard").write.partitionBy("shard").mode("overwrite").parquet(path)


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    * size: UTF-8 bytes of the text (null: none) plus 8; text_crc32 of the same bytes (null: of none)
    * shard, grown_shard: jump consistent hash of doc_id over ``shards`` and ``shards`` + 1
    * slot: the row's place in its shard, gapless from 0; equal rows take neighbouring slots

    Null doc_id is a key like any other. Empty input gives an empty result. Other columns of ``docs`` don't
    matter, whatever their names. Repeated rows are counted before the shuffle and laid out again after it,
    so a group of copies never meets in one window.
    """
    body = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       (F.octet_length(body).cast("bigint") + 8).alias("size"),
                       F.crc32(body).alias("text_crc32"))
    counted = stage(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_copies")), "shards")
    chunks = max(1, math.ceil(counted.count() / shards / ROWS_PER_CHUNK))
    placed = (with_shard(counted, "doc_id", shards)
              .withColumn("grown_shard", jump_shard(F.col("doc_id"), shards + 1))
              .withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(chunks)).cast("int")))
    placed = running_sum(placed, ["shard"], "_chunk", ["doc_id", "text_crc32", "size"], "_copies", "_first")
    return (placed.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("_first") + F.col("_copy")).cast("bigint").alias("slot"), "grown_shard"))
