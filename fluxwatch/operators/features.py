"""Packet log -> per-flow features.

Ordering packets inside a flow needs a window, and a window partition is one
task. A flow may hold a large share of all packets, so flows above ``max_rows``
are cut at quantiles of their packet times into ranges of about equal row
count. Inside a range the packets of one instant are summed up first (the gaps
between them are zero), then gaps are taken between instants; one segment per
range (first, last, counts, means, squared deviations) goes on, and segments
are merged per flow together with the gaps between them. Smaller flows take the
plain way: one shuffle, one window.

Everything is planned lazily. Where no flow is large, adaptive execution finds
the list of large flows empty and drops that branch with its scans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxwatch.functions.scalars import guard_duration

# A flow with more packets than this is cut into ranges. The tables that are
# sent to every task (large flows, their bounds, large instants) have at most
# (all packets / MAX_ROWS) rows or bounds: 400,000 at 100 TB of packet log.
MAX_ROWS = 2_000_000
# Quantiles taken of a large flow, and so the most ranges it is cut into.
QUANTILES = 4096
# Bounds searched one by one; of longer lists every such bound is tried first.
STRIDE = 64

_SLICE = "__slice"
CONSTANT = ["attack_type", "pqc_enabled", "kem_handshake_ms", "sig_sign_ms", "sig_verify_ms"]


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def _sent(rows: DataFrame, small: DataFrame, key: list[str], how: str) -> DataFrame:
    """Joins a table of bounded size on ``key`` (null keys are equal), which leaves ``rows`` where they are."""
    names = [f"__s_{k}" for k in key]
    renamed = small.withColumnsRenamed(dict(zip(key, names)))
    return rows.join(F.broadcast(renamed), _same(key, names), how).drop(*names)


def hot_flows(packets: DataFrame, key: list[str], max_rows: int = MAX_ROWS) -> DataFrame:
    """The flows of more than ``max_rows`` packets, with their count ``__n``."""
    return packets.groupBy(*key).agg(F.count("*").alias("__n")).filter(F.col("__n") > max_rows)


def _bounds(packets: DataFrame, hot: DataFrame, key: list[str], ts: str, max_rows: int) -> DataFrame:
    """Per large flow the times ``__cuts`` at which its ranges begin, and every STRIDE-th of them."""
    # one constant instead of thousands of plan nodes
    points = F.split(F.lit(",".join(str(i / QUANTILES) for i in range(1, QUANTILES))), ",").cast("array<double>")
    found = _sent(packets, hot, key, "inner").groupBy(*key).agg(
        F.max("__n").alias("__n"), F.percentile_approx(ts, points, 16 * QUANTILES).alias("__q")
    )
    parts = F.least(F.ceil(F.col("__n") / max_rows), F.lit(QUANTILES)).cast("int")
    picked = F.transform(
        F.sequence(F.lit(1), F.col("__parts") - 1),
        lambda i: F.element_at("__q", F.floor(i * F.lit(QUANTILES) / F.col("__parts")).cast("int")),
    )
    cuts = found.withColumn("__parts", parts).withColumn("__cuts", F.array_sort(F.array_distinct(picked)))
    strides = F.floor(F.size("__cuts") / STRIDE).cast("int")
    every = F.when(
        strides > 0, F.transform(F.sequence(F.lit(1), strides), lambda i: F.element_at("__cuts", i * STRIDE))
    ).otherwise(F.array().cast("array<double>"))
    return cuts.select(*key, "__cuts", every.alias("__every"))


def _at_or_below(cuts: Column, every: Column, value: Column) -> Column:
    """How many of the sorted ``cuts`` are at or below the value, by two short searches."""
    begun = F.size(F.filter(every, lambda b: b <= value)) * STRIDE
    return begun + F.size(F.filter(F.slice(cuts, begun + 1, F.lit(STRIDE)), lambda b: b <= value))


def split_by_size(
    packets: DataFrame, key: list[str], ts: str, max_rows: int = MAX_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Packets of ordinary flows, and those of large flows with the range ``__slice`` they fall into.

    Ranges follow the time and hold about ``max_rows`` packets, up to QUANTILES ranges a flow, however
    unevenly the packets lie in time. Only packets of one instant are never parted.
    """
    hot = hot_flows(packets, key, max_rows)
    cuts = _bounds(packets, hot, key, ts, max_rows)
    place = _at_or_below(F.col("__cuts"), F.col("__every"), F.col(ts).cast("double"))
    sliced = _sent(packets, cuts, key, "inner").withColumn(_SLICE, place).drop("__cuts", "__every")
    return _sent(packets, hot, key, "left_anti"), sliced


def _only(packets: DataFrame, directions: tuple[str, ...] | None) -> DataFrame:
    return packets if directions is None else packets.filter(F.col("direction").isin(*directions))


def packet_iat(
    packets: DataFrame,
    key: list[str] | None = None,
    ts: str = "timestamp_s",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Adds ``iat``: seconds since the flow's previous packet, null on the first one.

    Of an instant with more than ``max_rows`` packets one is ordered with the rest, the others
    have a gap of zero wherever they are.
    """
    key = key or ["flow_id"]
    plain, sliced = split_by_size(packets.withColumn("__id", F.monotonically_increasing_id()), key, ts, max_rows)
    alone = plain.withColumn("iat", F.col(ts) - F.lag(ts).over(Window.partitionBy(*key).orderBy(ts)))

    crowded = sliced.groupBy(*key, ts).agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    crowded = crowded.filter(F.col("__n") > max_rows).drop("__n")
    told = _sent(sliced, crowded, [*key, ts], "left")
    others = told.filter(F.col("__first") != F.col("__id")).withColumn("iat", F.lit(0.0))
    ordered = told.filter(F.coalesce(F.col("__first") == F.col("__id"), F.lit(True)))
    across = Window.partitionBy(*key).orderBy(_SLICE)
    # one row a range, as many as all packets / max_rows
    ends = ordered.groupBy(*key, _SLICE).agg(F.max(ts).alias("__end"))
    ends = ends.withColumn("__before", F.lag("__end").over(across)).drop("__end")
    inside = Window.partitionBy(*key, _SLICE).orderBy(ts)
    previous = F.coalesce(F.lag(ts).over(inside), F.col("__before"))
    chained = _sent(ordered, ends, [*key, _SLICE], "left").withColumn("iat", F.col(ts) - previous)
    scratch = ["__id", "__first", "__before", _SLICE]
    return alone.drop("__id").unionByName(chained.drop(*scratch)).unionByName(others.drop(*scratch))


def _squares(column: str) -> Column:
    """Sum of squared deviations from the mean of a column."""
    return F.var_pop(column) * F.count(column)


def _sample_std(squares: Column, count: Column) -> Column:
    return F.when(count > 1, F.sqrt(squares / (count - 1)))


def _plain_flows(packets: DataFrame, key: list[str], ts: str) -> DataFrame:
    gaps = packets.withColumn("__iat", F.col(ts) - F.lag(ts).over(Window.partitionBy(*key).orderBy(ts)))
    return gaps.groupBy(*key).agg(
        (F.max(ts) - F.min(ts)).alias("Flow_Duration"),
        F.count("*").alias("Total_Fwd_Packets"),
        F.sum("packet_size_bytes").alias("bytes"),
        F.avg("__iat").alias("Flow_IAT_Mean"),
        F.stddev_samp("__iat").alias("Flow_IAT_Std"),
        F.max("__iat").alias("Flow_IAT_Max"),
        F.min("__iat").alias("Flow_IAT_Min"),
        F.avg("packet_size_bytes").alias("Fwd_Pkt_Len_Mean"),
        F.stddev_samp("packet_size_bytes").alias("Fwd_Pkt_Len_Std"),
        F.max("packet_size_bytes").alias("Fwd_Pkt_Len_Max"),
        F.min("packet_size_bytes").alias("Fwd_Pkt_Len_Min"),
        F.min(F.struct(F.col(ts).alias("ts"), *CONSTANT)).alias("head"),
    )


def segments(sliced: DataFrame, key: list[str], ts: str) -> DataFrame:
    """One row per range of a large flow: what merging needs, whatever the number of packets.

    Packets of an instant are summed up where they are read, so an instant never meets in one task as rows.
    """
    instants = sliced.groupBy(*key, _SLICE, F.col(ts).alias("t")).agg(
        F.count("*").alias("n"),
        F.sum("packet_size_bytes").alias("bytes"),
        F.count("packet_size_bytes").alias("len_n"),
        F.avg("packet_size_bytes").alias("len_mean"),
        _squares("packet_size_bytes").alias("len_sq"),
        F.max("packet_size_bytes").alias("len_max"),
        F.min("packet_size_bytes").alias("len_min"),
        F.min(F.struct(F.col(ts).alias("ts"), *CONSTANT)).alias("head"),
    )
    whole = Window.partitionBy(*key, _SLICE)
    centre = F.try_divide(F.sum("bytes").over(whole), F.sum("len_n").over(whole))
    chained = instants.withColumns({"gap": F.col("t") - F.lag("t").over(whole.orderBy("t")), "len_avg": centre})
    spread = F.coalesce(F.col("len_sq") + F.col("len_n") * F.pow(F.col("len_mean") - F.col("len_avg"), 2), F.lit(0.0))
    summed = chained.groupBy(*key, _SLICE).agg(
        F.min("t").alias("t0"),
        F.max("t").alias("t1"),
        F.sum("n").alias("packets"),
        F.sum("bytes").alias("bytes"),
        F.sum("len_n").alias("len_n"),
        F.max("len_avg").alias("len_mean"),
        F.sum(spread).alias("len_sq"),
        F.max("len_max").alias("len_max"),
        F.min("len_min").alias("len_min"),
        # gaps between instants, and how many gaps of zero lie inside them
        F.count("gap").alias("gap_n"),
        F.coalesce(F.avg("gap"), F.lit(0.0)).alias("gap_mean"),
        F.coalesce(_squares("gap"), F.lit(0.0)).alias("gap_sq"),
        F.max("gap").alias("gap_max"),
        F.min("gap").alias("gap_min"),
        F.sum(F.when(F.col("t").isNotNull(), F.col("n") - 1)).alias("zeros"),
        F.min("head").alias("head"),
    )
    n = F.col("gap_n") + F.coalesce("zeros", F.lit(0))
    mean = F.coalesce(F.try_divide(F.col("gap_n") * F.col("gap_mean"), n), F.lit(0.0))
    squares = F.col("gap_sq") + F.col("gap_n") * F.pow(F.col("gap_mean") - F.col("iat_mean"), 2) + F.coalesce("zeros", F.lit(0)) * F.pow("iat_mean", 2)
    tie = F.when(F.col("zeros") > 0, 0.0)
    return summed.withColumns(
        {"iat_n": n, "iat_mean": mean, "iat_max": F.greatest("gap_max", tie), "iat_min": F.least("gap_min", tie)}
    ).withColumn("iat_sq", squares).drop("gap_n", "gap_mean", "gap_sq", "gap_max", "gap_min", "zeros")


def _merged_flows(parts: DataFrame, key: list[str]) -> DataFrame:
    """Flows of the segments: counts, means and squared deviations merged, gaps between segments added."""
    chain = Window.partitionBy(*key).orderBy(_SLICE)
    whole = Window.partitionBy(*key)
    joined = parts.withColumn("gap", F.col("t0") - F.lag("t1").over(chain))
    totals = joined.withColumns(
        {
            "iat_total": F.sum(F.col("iat_n") + F.col("gap").isNotNull().cast("long")).over(whole),
            "iat_sum": F.sum(F.col("iat_n") * F.col("iat_mean") + F.coalesce("gap", F.lit(0.0))).over(whole),
            "len_total": F.sum("len_n").over(whole),
            "bytes_total": F.sum("bytes").over(whole),
        }
    )
    centred = totals.withColumns(
        {
            "iat_avg": F.try_divide("iat_sum", "iat_total"),
            "len_avg": F.try_divide("bytes_total", "len_total"),
        }
    )
    iat_sq = (
        F.col("iat_sq")
        + F.col("iat_n") * F.pow(F.col("iat_mean") - F.col("iat_avg"), 2)
        + F.coalesce(F.pow(F.col("gap") - F.col("iat_avg"), 2), F.lit(0.0))
    )
    len_sq = F.col("len_sq") + F.col("len_n") * F.pow(F.col("len_mean") - F.col("len_avg"), 2)
    return centred.groupBy(*key).agg(
        (F.max("t1") - F.min("t0")).alias("Flow_Duration"),
        F.sum("packets").alias("Total_Fwd_Packets"),
        F.sum("bytes").alias("bytes"),
        F.max("iat_avg").alias("Flow_IAT_Mean"),
        _sample_std(F.sum(iat_sq), F.max("iat_total")).alias("Flow_IAT_Std"),
        F.max(F.greatest("iat_max", "gap")).alias("Flow_IAT_Max"),
        F.min(F.least("iat_min", "gap")).alias("Flow_IAT_Min"),
        F.max("len_avg").alias("Fwd_Pkt_Len_Mean"),
        _sample_std(F.sum(len_sq), F.max("len_total")).alias("Fwd_Pkt_Len_Std"),
        F.max("len_max").alias("Fwd_Pkt_Len_Max"),
        F.min("len_min").alias("Fwd_Pkt_Len_Min"),
        F.min("head").alias("head"),
    )


def flow_features(
    packets: DataFrame,
    key: list[str] | None = None,
    ts: str = "timestamp_s",
    directions: tuple[str, ...] | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """One row per flow with the training columns; gaps are in seconds.

    Counts cover every packet row of the flow, sent and received alike, unless
    ``directions`` restricts them. Columns that are constant per flow are taken
    from its earliest packet, which makes the result independent of row order.
    """
    key = key or ["flow_id"]
    plain, sliced = split_by_size(_only(packets, directions), key, ts, max_rows)
    flows = _plain_flows(plain, key, ts).unionByName(_merged_flows(segments(sliced, key, ts), key))
    span = guard_duration(F.col("Flow_Duration"))
    return flows.select(
        *key,
        "Flow_Duration",
        "Total_Fwd_Packets",
        (F.col("bytes") / span).alias("Flow_Bytes_s"),
        (F.col("Total_Fwd_Packets") / span).alias("Flow_Packets_s"),
        "Flow_IAT_Mean", "Flow_IAT_Std", "Flow_IAT_Max", "Flow_IAT_Min",
        "Fwd_Pkt_Len_Mean", "Fwd_Pkt_Len_Std", "Fwd_Pkt_Len_Max", "Fwd_Pkt_Len_Min",
        F.col("head.attack_type").alias("Attack_Type"),
        F.col("head.pqc_enabled").alias("PQC_Enabled"),
        F.col("head.kem_handshake_ms").alias("KEM_Handshake_ms"),
        F.col("head.sig_sign_ms").alias("SIG_Sign_ms"),
        F.col("head.sig_verify_ms").alias("SIG_Verify_ms"),
    ).na.fill(0.0)


def training_flows(df: DataFrame, **options) -> DataFrame:
    """Flow rows for training: packet rows are aggregated, flow rows pass through."""
    return flow_features(df, **options) if "packet_size_bytes" in df.columns else df
