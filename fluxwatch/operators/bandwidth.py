"""Packet log -> bandwidth per second."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxwatch.functions.scalars import time_bucket, to_mega

_NAMES = {"tx": "tx_bytes_per_sec", "rx": "rx_bytes_per_sec"}


def bandwidth_series(
    packets: DataFrame, by: list[str] | None = None, strict_columns: bool = False
) -> DataFrame:
    """Bytes per second, direction and series key; seconds without packets are absent.

    One conditional aggregate: partial sums per task, one exchange of at most
    one row per second and task. ``strict_columns`` looks up which directions
    occur, and with one of them missing keeps the raw names and no total.
    """
    by = by or []
    bucket = time_bucket(F.col("timestamp_s")).alias("time_bucket")

    def volume(direction: str) -> Column:
        seen = F.when(F.col("direction") == direction, F.col("packet_size_bytes"))
        return F.coalesce(F.sum(seen), F.lit(0).cast("long"))

    if strict_columns:
        seen = packets.agg(*[F.max(F.col("direction") == d).alias(d) for d in _NAMES]).first()
        found = sorted(d for d in _NAMES if seen[d])
        if len(found) < len(_NAMES):
            return packets.groupBy(*by, bucket).agg(*[volume(d).alias(d) for d in found])
    sums = packets.groupBy(*by, bucket).agg(*[volume(d).alias(n) for d, n in _NAMES.items()])
    total = F.col("tx_bytes_per_sec") + F.col("rx_bytes_per_sec")
    return sums.withColumn("total_bytes_per_sec", total)


def in_megabytes(series: DataFrame) -> DataFrame:
    """Byte rates as MB/s under the names ``tx, rx, total``."""
    short = {"tx": "tx_bytes_per_sec", "rx": "rx_bytes_per_sec", "total": "total_bytes_per_sec"}
    return series.withColumns({k: to_mega(F.col(v)) for k, v in short.items()}).drop(
        *short.values()
    )
