"""Sharding by rendezvous hashing over weighted shards, and a row's place in its shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwatch.llm.common import numbered, table, utf8_bytes

SHARDS = 16


def rendezvous(key: F.Column, weights: list[float]) -> F.Column:
    """The shard a key belongs to: each shard draws an exponential clock from the hash of
    (key, shard) at the rate of its weight, and the earliest wins. Adding a shard or raising a
    weight moves rows only into that shard. A null key is hashed as the text ``null``; a shard
    of weight 0 gets nothing; equal clocks go to the lower shard."""
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    name = F.coalesce(key.cast("string"), F.lit("null"))

    def clock(shard: int, weight: float) -> F.Column:
        draw = F.shiftrightunsigned(F.xxhash64(name, F.lit(shard)), 11).cast("double") + 0.5
        return F.struct((-F.log(draw / float(1 << 53)) / weight).alias("clock"), F.lit(shard).alias("shard"))

    clocks = [clock(i, w) for i, w in enumerate(weights) if w > 0]
    return (F.least(*clocks) if len(clocks) > 1 else clocks[0]).getField("shard")


def shard(df: DataFrame, key: str = "doc_id", weights: list[float] | None = None, out: str = "shard") -> DataFrame:
    """``df`` with the shard of each row, a column computed in the scan: no shuffle.

    All rows of one key share a shard. An existing column named ``out`` is replaced.
    """
    return df.withColumn(out, rendezvous(F.col(key), weights or [1.0] * SHARDS))


def slots(df: DataFrame, shard: str = "shard", out: str = "slot") -> DataFrame:
    """``df`` with each row's gapless 0-based place in its shard."""
    return numbered(df.drop(out), [shard], "slots", out)


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", (utf8_bytes("text") + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
    )
    placed = shard(shard(docs, weights=[1.0] * SHARDS), weights=[1.0] * (SHARDS + 1), out="grown_shard")
    return slots(placed).select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
